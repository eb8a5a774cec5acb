"""aerolake: a Spark-native air-quality / weather lakehouse.

Landing JSON streams into bronze tables, named row rules clean them, facts
are kept once per hashed key, and gold views, planning queries and audits
are built from silver dimensions and facts.  Everything is DataFrame /
Spark SQL / Structured Streaming; no custom engine code.
"""

__all__ = ["session"]
