"""Column -> Column helpers (H-ops).  Everything here is a built-in Spark
expression so it stays JVM-side inside whole-stage codegen."""

from quaestor.functions.numeric import *  # noqa: F401,F403
from quaestor.functions import dates, strings, codes, identifiers, hashing, semistructured  # noqa: F401
