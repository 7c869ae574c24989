"""Inputs and outputs: explicit schemas, CSV / JSON / Parquet readers and writers,
and the fixture tables Spark derives from the driver's tables."""
