from oreflow.streaming.jobs import repartition_state, run_bronze, run_for, run_gold, run_silver, run_tail
from oreflow.streaming.watch import LossCounter, drop_read, listening, run_until_idle, supervised, uncommitted

__all__ = [
    "LossCounter",
    "drop_read",
    "listening",
    "repartition_state",
    "run_bronze",
    "run_for",
    "run_gold",
    "run_silver",
    "run_tail",
    "run_until_idle",
    "supervised",
    "uncommitted",
]
