"""labelcorpus: labelled benchmark tables from recipe data, as Spark DataFrame operators."""

__version__ = "0.1.0"
