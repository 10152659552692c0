"""starmart: a Spark-native build of an arrivals star schema.

Every operator takes and returns DataFrames; nothing runs until the caller asks
for an action, except the few functions documented as actions (writers, gates,
and ``plans.build``).
"""

__version__ = "0.1.0"
