"""phenospark — codelist-driven event phenotyping on Spark.

Dictionary -> catalog -> master codelist; coded records (narrow and wide)
x codelist -> mentions; mentions -> first dates, occurrence counts, flag
matrix; phenotype -> category mapping; coverage summaries and integrity
checks. Every stage is a DataFrame -> DataFrame function.
"""

__version__ = "0.1.0"
