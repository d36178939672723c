from oreflow.sources.tables import read_between, read_table, stream_table
from oreflow.sources.topics import Topic, read_topic, round_trip, stream_topic, write_topic

__all__ = [
    "Topic",
    "read_between",
    "read_table",
    "read_topic",
    "round_trip",
    "stream_table",
    "stream_topic",
    "write_topic",
]
