"""vaultspark: lake tables and change streams to a Data Vault 2.0 model, on Spark.

Layers
------
functions   Column expressions (names, canonical text, hashes, message classes)
sources     lake tables, JDBC, change envelopes, bronze and vault storage
operators   DataFrame -> DataFrame steps, one module per concern
plans       jobs built from the operators (capture, vault load, evolution)
streaming   Structured Streaming entry points over the same operators
queries     ready-made queries over the driver's tables, with their SQL oracles
"""

__version__ = "0.1.0"
