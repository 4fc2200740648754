"""opslake — a Spark-native flight-operations lakehouse.

Layers: bronze (text, provenance, rescued rows) → silver (typed mirror, data
contract, quarantine) → gold (airport dimension, deduplicated fact, OBT) →
reports and a quality gate. Everything is expressed with the DataFrame API.
"""

__version__ = "0.1.0"
