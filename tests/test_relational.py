"""No database may be started here, so only what is asked of Spark is checked."""

from unittest.mock import MagicMock

from gridtide.sources import relational


class Recorder:
    """Stands in for a reader or writer and notes the options it is given."""

    def __init__(self):
        self.seen = {}
        self.end = MagicMock()

    def option(self, key, value):
        self.seen[key] = value
        return self

    def options(self, **more):
        self.seen |= more
        return self

    def format(self, name):
        return self.option("format", name)

    def mode(self, name):
        return self.option("mode", name)

    def load(self):
        return self.end.load()

    def save(self):
        return self.end.save()


def test_read_is_split_over_tasks():
    reader = Recorder()
    relational.read_table(MagicMock(read=reader), "jdbc:x", "t", "h", "2024-01-01", "2025-01-01", 16, user="u")
    assert reader.seen == {
        "format": "jdbc",
        "url": "jdbc:x",
        "dbtable": "t",
        "partitionColumn": "h",
        "lowerBound": "2024-01-01",
        "upperBound": "2025-01-01",
        "numPartitions": 16,
        "preferTimestampNTZ": "true",
        "user": "u",
    }
    reader.end.load.assert_called_once()


def test_write_keeps_the_table_and_bounds_connections():
    writer = Recorder()
    relational.write_table(MagicMock(write=writer), "jdbc:x", "t", writers=4)
    assert writer.seen["truncate"] == "true" and writer.seen["mode"] == "overwrite"
    assert writer.seen["numPartitions"] == 4 and writer.seen["batchsize"] == 10_000
    writer.end.save.assert_called_once()
