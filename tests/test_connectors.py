"""Options handed to connectors that this machine does not have; nothing is sent."""

from unittest.mock import MagicMock

from tripmill import sinks, streaming


def test_jdbc_replaces_and_appends_in_batches():
    df = MagicMock()
    sinks.write_jdbc(df, "jdbc:x", "trips", connections=8, properties={"user": "u"})
    df.write.mode.assert_called_once_with("overwrite")
    options = df.write.mode.return_value.options
    options.assert_called_once_with(batchsize="100000", user="u", numPartitions="8")
    options.return_value.jdbc.assert_called_once_with("jdbc:x", "trips")


def test_topic_sink():
    df = MagicMock()
    sinks.publish_json(df, kafka={"topic": "green-trips", "kafka.bootstrap.servers": "h:1"})
    writer = df.select.return_value.write.format
    writer.assert_called_once_with("kafka")
    writer.return_value.options.return_value.save.assert_called_once_with()


def test_topic_source_starts_with_the_earliest_message(spark):
    session = MagicMock()
    session.readStream.format.return_value.options.return_value.load.return_value = (
        spark.createDataFrame([(b'{"PULocationID": 7}',)], "value binary")
    )
    df = streaming.stream_trips(session, kafka={"subscribe": "green-trips"})
    assert df.first().PULocationID == 7
    session.readStream.format.assert_called_once_with("kafka")
    session.readStream.format.return_value.options.assert_called_once_with(
        startingOffsets="earliest", subscribe="green-trips"
    )


def test_bounded_topic_read(spark):
    session = MagicMock()
    session.read.format.return_value.options.return_value.load.return_value = (
        spark.createDataFrame([(b'{"tip_amount": 2.5}',), (b"broken",)], "value binary")
    )
    df = streaming.read_topic(session, kafka={"subscribe": "green-trips"})
    assert [r.tip_amount for r in df.collect()] == [2.5, None]
    session.read.format.return_value.options.assert_called_once_with(
        startingOffsets="earliest", endingOffsets="latest", subscribe="green-trips"
    )
