"""Column functions: everything here is `Column -> Column` and stays in the JVM
(the one exception is `urls.resolve_url`, an Arrow-batched pandas UDF)."""
