"""Every operator as a query on the test tables, with check SQL where SQL can express it."""

from bondscope.queries import analysis, boosted, categories, features, learned, pairs, rows, stores

QUERIES = {**rows.QUERIES, **pairs.QUERIES, **analysis.QUERIES, **features.QUERIES, **learned.QUERIES, **boosted.QUERIES, **stores.QUERIES, **categories.QUERIES}
ORACLE = {**rows.ORACLE, **pairs.ORACLE, **analysis.ORACLE, **features.ORACLE, **boosted.ORACLE, **stores.ORACLE, **categories.ORACLE}
