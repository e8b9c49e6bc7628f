"""Quality control of parallel text, and operators of training-data pipelines, as Spark plans."""
