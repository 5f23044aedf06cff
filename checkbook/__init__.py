"""Maps the driver's test tables onto the engine and states the expected answers in DuckDB SQL."""
