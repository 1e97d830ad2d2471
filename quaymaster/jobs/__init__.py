"""Entry scripts for spark-submit: ``python -m quaymaster.jobs.kpis`` and so on."""
