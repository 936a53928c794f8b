"""starforge: a Spark-native medallion (bronze -> silver -> gold) and
star-schema library.

Raw delimited extracts are scanned with fixed schemas, cleaned with
ANSI-safe built-in expressions into silver tables, and turned into a
dimensional model (client, product, calendar, priority and ticket
dimensions; contract, ticket and survey facts) with deterministic,
distributed surrogate keys.  Every operator is a plain DataFrame
transformation so Catalyst can prune, push down and plan it.
"""

from starforge.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
__version__ = "0.1.0"
