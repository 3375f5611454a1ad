"""sedimenta: land, conform, model, enrich and report on public records with Spark.

Every step is a function from DataFrame to DataFrame, described by a small table
specification (`sedimenta.spec`). See README.md for the tour.
"""

__version__ = "0.1.0"
