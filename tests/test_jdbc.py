"""What is asked of the JDBC reader and writer; no database is contacted."""

import datetime as dt

from lakeloom.sources.jdbc import JdbcTable


class Recorder:
    """Stands in for a session's reader: records options, returns given frames."""

    def __init__(self, *frames):
        self.frames, self.calls = list(frames), []
        self.read = self

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.calls.append(options)
        return self

    def load(self):
        return self.frames.pop(0)


TABLE = JdbcTable("jdbc:x:y", "sales.orders", {"user": "u"}, partition_column="id", partitions=4)


def test_partitioned_read_asks_for_bounds_in_the_database(spark):
    bounds = spark.createDataFrame([(1, 100)], "a int, b int")
    reader = Recorder(bounds, spark.range(3))
    assert TABLE.read(reader).count() == 3
    assert reader.calls[0]["query"] == "SELECT MIN(id) AS low_value, MAX(id) AS high_value FROM sales.orders"
    assert reader.calls[1] == {
        "url": "jdbc:x:y", "user": "u", "fetchsize": "10000", "dbtable": "sales.orders", "partitionColumn": "id",
        "lowerBound": "1", "upperBound": "100", "numPartitions": "4",
    }


def test_empty_table_is_read_without_bounds(spark):
    reader = Recorder(spark.createDataFrame([(None, None)], "a int, b int"), spark.range(0))
    assert TABLE.read(reader).count() == 0 and "partitionColumn" not in reader.calls[1]


def test_high_value_is_computed_in_the_database(spark):
    reader = Recorder(spark.createDataFrame([(7,)], "a int"))
    assert TABLE.high_value(reader, "modified") == 7
    assert reader.calls[0]["query"] == "SELECT MAX(modified) AS high_value FROM sales.orders"


def test_window_is_open_below_and_closed_above(spark):
    days = [dt.datetime(2024, 1, day) for day in (1, 2, 3)]
    rows = spark.createDataFrame([(day,) for day in days], "modified timestamp")
    table = JdbcTable("jdbc:x:y", "t", partitions=2)
    reader = Recorder(spark.createDataFrame([(days[0], days[2])], "a timestamp, b timestamp"), rows)
    window = table.read_between(reader, "modified", days[0], days[1])
    assert [row[0] for row in window.collect()] == [days[1]]
    assert reader.calls[1]["partitionColumn"] == "modified"
    assert reader.calls[1]["lowerBound"] == "2024-01-01 00:00:00"


def test_splits_begin_where_rows_do(spark):
    day, later = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    for low, first in ((dt.datetime(1900, 1, 1), day), (dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 15))):
        reader = Recorder(spark.createDataFrame([(day, later)], "a timestamp, b timestamp"), spark.createDataFrame([], "modified timestamp"))
        JdbcTable("jdbc:x:y", "t", partitions=2).read_between(reader, "modified", low, later)
        assert reader.calls[1]["lowerBound"] == str(first) and reader.calls[1]["upperBound"] == str(later)


class Sink(Recorder):
    """Stands in for a frame that is written."""

    def __init__(self):
        super().__init__()
        self.write, self.saved = self, False

    def mode(self, name):
        assert name == "append"
        return self

    def save(self):
        self.saved = True


def test_append_writes_in_batches():
    sink = Sink()
    TABLE.append(sink)
    assert sink.saved and sink.calls[0]["batchsize"] == "10000" and sink.calls[0]["dbtable"] == "sales.orders"
