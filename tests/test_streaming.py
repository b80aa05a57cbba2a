from askframe.operators.greeting import greet
from askframe.operators.search import search
from askframe.sources.requests import read_requests, stream_requests, write_messages
from askframe.streaming.answers import answer_stream


def write_requests(spark, path, lines):
    spark.createDataFrame([(l,) for l in lines], "line string").coalesce(1).write.mode("append").parquet(path)


def test_greetings_arrive_once(spark, tmp_path):
    arriving, out, checkpoint = (str(tmp_path / d) for d in ("in", "out", "checkpoint"))
    write_requests(spark, arriving, ["Ann 25", "Bob x"])

    def run():
        stream = spark.readStream.schema("line string").parquet(arriving)
        answer_stream(stream, greet, out, checkpoint, once=True).awaitTermination()
        return sorted((r.name, r.status) for r in spark.read.parquet(out).collect())

    assert run() == [("Ann", "ok"), ("Bob", "bad_age")]
    assert run() == [("Ann", "ok"), ("Bob", "bad_age")]
    write_requests(spark, arriving, ["Cid 1"])
    assert run() == [("Ann", "ok"), ("Bob", "bad_age"), ("Cid", "ok")]


def test_lines_of_files(spark, tmp_path):
    asked, out, checkpoint = (str(tmp_path / d) for d in ("asked", "out", "checkpoint"))
    (tmp_path / "asked").mkdir()
    (tmp_path / "asked" / "one").write_bytes("Ann 25\n\r\nBob\t\n".encode())
    batch = read_requests(spark, asked).collect()
    assert [r.line for r in batch] == ["Ann 25", "\r", "Bob\t"] and len({r.request_id for r in batch}) == 3
    answer_stream(stream_requests(spark, asked), greet, out, checkpoint, once=True).awaitTermination()
    answers = spark.read.parquet(out)
    assert {(r.name, r.age_text) for r in answers.collect()} == {("Ann", "25"), ("Bob", None), ("\r", None)}
    write_messages(answers, str(tmp_path / "said"))
    said = spark.read.text(str(tmp_path / "said")).collect()
    assert [r.value for r in said] == ["Привет, Ann! Через год тебе будет 26 лет."]


def test_searches_against_a_table(spark, tmp_path):
    arriving, out, checkpoint = (str(tmp_path / d) for d in ("in", "out", "checkpoint"))
    spark.createDataFrame([("*.txt",), ("x",)], "pattern string").write.parquet(arriving)
    names = spark.createDataFrame([("a.txt",)], "name string")
    stream = spark.readStream.schema("pattern string").parquet(arriving)
    answer_stream(stream, lambda batch: search(batch, names), out, checkpoint, once=True).awaitTermination()
    assert {r.pattern: r.found for r in spark.read.parquet(out).collect()} == {"*.txt": True, "x": False}
