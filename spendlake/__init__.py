"""spendlake: bank-export analytics on Spark.

Exports -> raw transactions (newest export wins, key dedupe) -> staged ->
categorised -> star schema (fact + date, account, category dimensions) ->
reports and data-quality checks.  Every step is a DataFrame function.
"""

__version__ = "0.1.0"
