"""lakelayer: layered (raw / bronze / silver / gold) data work on Spark DataFrames.

Incremental extraction with high-water marks, file-stream ingestion with schema
evolution and rescued data, expectations, SCD type 1 / type 2 change application
(batch and Structured Streaming), nested-record flattening, star joins and gold
models, all as DataFrame plans.
"""

__version__ = "0.1.0"
