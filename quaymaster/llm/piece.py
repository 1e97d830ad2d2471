"""SentencePiece encoding of merge type (BPE) by a table of last tokens, and decoding.

Every prefix of a text has one encoding, and its last token is all that has to be stored: a
token that ends at a position is the last one exactly if it forms a compatible pair with
the last token of the prefix before it, that is, if merging the two tokens' characters gives
the two tokens back. An Aho-Corasick automaton over the vocabulary lists the tokens that end
at each position; compatibility of a pair is worked out once and remembered. The ids are
then read off the table backwards. Work is linear in the text, also for one endless word.

No piece crosses the place where a space mark follows another character, or a character the
vocabulary lacks, so a text is cut there and the encodings of short stretches are remembered,
a bounded number of them. Characters outside the vocabulary become their UTF-8 byte pieces.

Null texts are empty and get the end id alone. Repeated rows are encoded each; other columns of
``docs`` ride along only in ``encode_columns``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute
import sentencepiece
from pyspark.sql import DataFrame

from quaymaster.llm.common import blocks_of, held, map_batches, texts_of

SPACE = "▁"
REMEMBERED = 300_000  # encodings of stretches in each of the two generations that a worker keeps
SHORT = 48  # characters of a stretch worth keeping


@dataclass
class LastTokenTable:
    """Encoder of one vocabulary."""

    model: bytes
    memo: dict = field(default_factory=dict)
    older: dict = field(default_factory=dict)
    pairs: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        sp = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        self.sp, self.end = sp, sp.eos_id()
        self.pieces = [sp.id_to_piece(i) for i in range(sp.vocab_size())]
        plain = [i for i in range(len(self.pieces)) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.ids = {self.pieces[i]: i for i in plain}
        self.score = {self.pieces[i]: sp.get_score(i) for i in plain}
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.automaton = ahocorasick.Automaton()
        for i in plain:
            if self.merged(self.pieces[i]) == [self.pieces[i]]:
                self.automaton.add_word(self.pieces[i], (i, len(self.pieces[i])))
        self.automaton.make_automaton()
        known = {p for p in self.ids if len(p) == 1}
        lacking = "".join(c for c in "\n\t\r" if c not in known)
        cut = re.escape(lacking)
        self.known = known
        self.stretches = re.compile(f"{SPACE}*[^{SPACE}{cut}]+|{SPACE}+" + (f"|[{cut}]" if cut else ""))

    def merged(self, text: str) -> list[str]:
        """Merge the best-scored neighbours, leftmost first, until none is a piece. For short texts."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: int, right: int) -> bool:
        key = left << 20 | right
        known = self.pairs.get(key)
        if known is None:
            a, b = self.pieces[left], self.pieces[right]
            known = self.pairs[key] = self.merged(a + b) == [a, b]
        return known

    def known_run(self, run: str) -> list[int]:
        """Ids of a run of characters that the vocabulary has."""
        whole = self.ids.get(run)
        if whole is not None and run in self.automaton:
            return [whole]
        last = [-1] * (len(run) + 1)
        pairs = self.pairs
        for end, (token, length) in self.automaton.iter(run):
            end += 1
            if last[end] >= 0:
                continue
            start = end - length
            if start == 0:
                last[end] = token
            else:
                before = last[start]
                if before >= 0:
                    fits = pairs.get(before << 20 | token)
                    if fits or fits is None and self.compatible(before, token):
                        last[end] = token
        ids, at = [], len(run)
        while at > 0:
            ids.append(last[at])
            at -= len(self.pieces[last[at]])
        ids.reverse()
        return ids

    def stretch(self, text: str) -> list[int]:
        known = self.known
        if known.issuperset(text):
            return self.known_run(text)
        ids: list[int] = []
        start = 0
        for i, c in enumerate(text):
            if c not in known:
                if i > start:
                    ids += self.known_run(text[start:i])
                ids += [self.bytes[b] for b in c.encode("utf-8")]
                start = i + 1
        if start < len(text):
            ids += self.known_run(text[start:])
        return ids

    def encode(self, text: str) -> list[int]:
        """Ids of a text, with the end id."""
        ids: list[int] = []
        if text:
            memo, extend = self.memo, ids.extend
            for s in self.stretches.findall(SPACE + text.replace(" ", SPACE)):
                found = memo.get(s)
                if found is None:
                    found = self.older.get(s)
                    if found is None:
                        found = self.stretch(s)
                    if len(s) <= SHORT:
                        if len(memo) >= REMEMBERED:
                            self.older, self.memo = memo, {}
                            memo = self.memo
                        memo[s] = tuple(found)
                extend(found)
        ids.append(self.end)
        return ids


def table_of(model: bytes) -> LastTokenTable:
    """The table of a worker; it is built once and serves all its tasks of a stage."""
    return held(("pieces", model), lambda: LastTokenTable(model))


def model_bytes(path: str) -> bytes:
    """The model file, read on the driver and sent along; half a megabyte for 32,000 pieces."""
    with open(path, "rb") as f:
        return f.read()


def encoder(model: bytes):
    def work(batch: pa.RecordBatch):
        table = table_of(model)
        texts, others = batch.column("text"), [c for c in batch.schema.names if c != "text"]
        lengths = np.nan_to_num(pa.compute.binary_length(texts).to_numpy(zero_copy_only=False))
        for start, stop in blocks_of(lengths):
            lists = [table.encode(t or "") for t in texts.slice(start, stop - start).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
            flat = np.fromiter((i for x in lists for i in x), np.int32, int(offsets[-1]))
            yield {
                **{c: batch.column(c).slice(start, stop - start) for c in others},
                "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                "decoded": table.sp.decode(lists),
            }

    return work


def encode_columns(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with its text replaced by ``ids`` (end id last) and ``decoded``."""
    others = [f for f in docs.schema.fields if f.name != "text"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in others] + ["ids array<int>", "decoded string"])
    return map_batches(docs, encoder(model_bytes(path)), schema, keeps=True)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and decoded text of every document."""
    return encode_columns(texts_of(docs), path)
