"""kedge: snapshot, history, linkage and audit operators for nested record corpora, on Spark DataFrames."""

__version__ = "0.1.0"
