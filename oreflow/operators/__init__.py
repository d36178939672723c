from oreflow.operators.bronze import to_bronze
from oreflow.operators.gold import positions
from oreflow.operators.messages import message_log, message_text
from oreflow.operators.silver import dedup_batch, dedup_stream, parse, typed, usable

__all__ = [
    "dedup_batch",
    "dedup_stream",
    "message_log",
    "message_text",
    "parse",
    "positions",
    "to_bronze",
    "typed",
    "usable",
]
