"""hirelake: Spark-native job-posting analytics.

Landing JSON and raw site payloads are normalised to one posting schema,
classified in a three-level category taxonomy, cleaned, geocoded through a
lookup table, split into term tables and rolled up into marts. Everything is
expressed with the DataFrame API and built-in functions so Catalyst plans it
and the work stays distributed.
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
