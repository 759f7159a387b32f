"""Column expressions: pure ``Column -> Column`` helpers, all JVM-side."""
from riskloom.functions.columns import *  # noqa: F401,F403
