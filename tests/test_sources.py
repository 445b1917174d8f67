import json

import pyarrow as pa
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tallyloom.functions import text as T
from tallyloom.sources import json_arrays as J
from tallyloom.sources import mail as M
from tallyloom.sources import tables as S
from tallyloom.sources.mail import decode_messages, ingest, read_label_index, read_messages, write_messages

PLAIN = b"From: A <a@x.example>\r\nContent-Type: text/plain; charset=utf-8\r\n\r\nhello\r\n"
HTML_FIRST = (
    b'From: b@y.example\r\nMIME-Version: 1.0\r\nContent-Type: multipart/mixed; boundary="q"\r\n\r\n'
    b"--q\r\nContent-Type: text/html; charset=utf-8\r\n\r\n<b>1</b>\r\n"
    b"--q\r\nContent-Type: text/plain; charset=utf-8\r\n\r\ntwo\r\n"
    b"--q\r\nContent-Type: text/plain; charset=utf-8\r\n\r\nthree\r\n--q--\r\n"
)
NESTED = (
    b'MIME-Version: 1.0\r\nContent-Type: multipart/mixed; boundary="o"\r\n\r\n--o\r\n'
    b'Content-Type: multipart/alternative; boundary="i"\r\n\r\n'
    b"--i\r\nContent-Type: text/plain\r\n\r\ninner\r\n--i\r\nContent-Type: text/html\r\n\r\n<i>x</i>\r\n--i--\r\n"
    b"--o\r\nContent-Type: text/html\r\n\r\n<p>later</p>\r\n--o--\r\n"
)
BAD_CHARSET = b"From: c@z.example\r\nContent-Type: text/plain; charset=no-such\r\n\r\nlost\r\n"
ALIAS_CHARSET = "From: d@z.example\r\nContent-Type: text/plain; charset=X-UNKNOWN\r\nContent-Transfer-Encoding: 8bit\r\n\r\nüb\r\n".encode()
IMAGE = b"From: e@z.example\r\nContent-Type: image/png\r\n\r\nxx\r\n"


def test_message_files_are_decoded_and_labelled(spark, tmp_path):
    mails = {"plain": PLAIN, "html_first": HTML_FIRST, "nested": NESTED, "bad": BAD_CHARSET, "alias": ALIAS_CHARSET, "image": IMAGE}
    (tmp_path / "data" / "000").mkdir(parents=True)
    (tmp_path / "label").mkdir()
    for name, content in mails.items():
        (tmp_path / "data" / "000" / name).write_bytes(content)
    lines = [f"{'spam' if n == 'bad' else 'ham'} ../data/000/{n}" for n in mails]
    (tmp_path / "label" / "index").write_text("\n".join(lines) + "\n")

    index = read_label_index(spark, str(tmp_path / "label" / "index"))
    files = read_messages(spark, str(tmp_path / "data"), str(tmp_path))
    rows = {r.path.split("/")[-1]: r for r in ingest(index, files).collect()}

    assert set(rows) == set(mails)
    body = {n: rows[n].body.replace("\r\n", "\n") for n in mails}
    assert body["plain"] == "hello\n"
    assert body["html_first"].replace("\n", "") == "<b>1</b>two"
    assert body["nested"].strip() == "inner"
    assert "later" not in body["nested"]
    assert body["bad"] == "" and rows["bad"].label == "spam"
    assert body["alias"].strip() == "üb"
    assert body["image"] == ""
    assert rows["nested"].sender is None and rows["plain"].sender == "A <a@x.example>"


def test_broken_message_keeps_its_row(spark):
    files = spark.createDataFrame([("p", bytearray(b"Content-Type: multipart/mixed\r\n\r\nno parts"))], "path string, content binary")
    assert decode_messages(files).first().path == "p"


def test_small_files_share_a_split_and_large_ones_fill_their_own(spark, tmp_path):
    for i in range(300):
        (tmp_path / f"m{i:03}").write_bytes(b"x" * 100)
    for name in "ab":
        (tmp_path / name).write_bytes(b"y" * 1_000_000)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    splits = read_messages(spark, str(tmp_path), split_bytes=1_000_000, split_files=100)
    spread = splits.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.max(F.length("content")).alias("most")).collect()
    assert sum(r.n for r in spread) == 302 and 5 <= len(spread) <= 8
    assert max(r.n for r in spread) <= 101
    # A plain scan counts every file as 4 MB.
    assert spark.read.format("binaryFile").load(str(tmp_path)).rdd.getNumPartitions() > len(spread)
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before
    index = spark.createDataFrame([("ham", "m007")], "label string, path string")
    assert ingest(index, splits.withColumn("path", F.substring_index("path", "/", -1))).count() == 1


def test_faults_are_counted_in_the_pass_that_reads(spark, tmp_path):
    bad_part = b"From: a@b.example\r\nContent-Type: text/plain; charset=\"a\x00b\"\r\n\r\nlost\r\n"
    mails = [("plain", PLAIN), ("bad", BAD_CHARSET), ("image", IMAGE), ("nested", NESTED), ("nul", bad_part), ("null", None), ("empty", b"")]
    files = spark.createDataFrame([(n, None if c is None else bytearray(c)) for n, c in mails], "path string, content binary")
    seen = Observation()
    rows = decode_messages(files, seen).collect()
    assert len(rows) == 7 and rows[0].asDict().keys() == {"path", "sender", "body"}
    assert seen.get["messages"] == 7 and seen.get["no_sender"] == 3 and seen.get["message"] == 0
    assert seen.get["charset"] + seen.get["part"] == 2 and seen.get["charset"] >= 1


def test_written_messages_come_back_one_file_each(spark, tmp_path):
    told = [("d", "1", "From: a@b.c\n\nfirst\nline"), ("d", "2", "\n"), ("p", "1", "ü" * 5)]
    write_messages(spark.createDataFrame(told, "folder string, name string, content string"), str(tmp_path / "m"))
    back = {tuple(r.path.split("/")[-3:-1]): bytes(r.content).decode() for r in read_messages(spark, str(tmp_path / "m")).collect()}
    assert back == {(f"folder={f}", f"name={n}"): c + "\n" for f, n, c in told}


def test_sender_modes(spark):
    senders = ["Name <u@a.com>", "no address", None, "x@y@z.org>", "u@a.com", "é@ü.com>"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(senders)], "i int, s string").orderBy("i")
    domain = [r[0] for r in df.select(T.sender_feature(F.col("s"))).collect()]
    assert domain == ["a.com", "no address", "", "z.org", "a.com", ".com"]
    full = [r[0] for r in df.select(T.sender_feature(F.col("s"), "full")).collect()]
    assert full[3:5] == ["x@y@z.org", "u@a.com"]
    assert {r[0] for r in df.select(T.sender_feature(F.col("s"), "none")).collect()} == {""}


def test_mail_features_of_empty_and_foreign_bodies(spark):
    df = spark.createDataFrame([("u@d.e>", ""), ("", "éü"), (None, None), ("", "caféteria, it's 5$\tok")], "s string, b string")
    assert [r[0] for r in df.select(T.mail_features(F.col("s"), F.col("b"))).collect()] == [
        ["d.e"], [], [], ["cafteria", ",", "it", "'", "s", "5", "$", "ok"]]


def test_word_tokens_are_unicode_words(spark):
    df = spark.createDataFrame([("Ünï_1 a bc, D E-F gh²",)], "t string")
    assert df.select(T.word_tokens(F.col("t"))).first()[0] == ["ünï_1", "bc", "gh²"]


def test_tab_separated_rows(spark, tmp_path):
    path = tmp_path / "r.tsv"
    path.write_text('a\tb\tc\n1\t2\t3\n1\t2\n1\t2\t3\t4\n 1\t"x\t\t\n\na\tb\tc\n')
    rows = [tuple(r) for r in S.read_tab_separated(spark, str(path)).collect()]
    assert rows == [("1", "2", "3"), ("1", "2", None), ("1", "2", "3"), ("1", '"x', None), ("", None, None), ("a", "b", "c")]


def test_json_array_file(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text(json.dumps([{"label": "spam", "data": ["a", "b"]}, {"label": "ham", "data": []}], indent=4))
    rows = J.read_json_array(spark, str(path), "label string, data array<string>").collect()
    assert [(r.label, r.data) for r in rows] == [("spam", ["a", "b"]), ("ham", [])]


def test_submission_numbers_from_one(spark, tmp_path):
    df = spark.createDataFrame([(i * 7, float(i)) for i in range(50)], "row long, p double").repartition(5)
    S.write_submission(S.submission(df, "row", "p"), str(tmp_path / "out"))
    text = sorted((tmp_path / "out").glob("part-*.csv"))
    lines = [line for part in text for line in part.read_text().splitlines() if line != "Id,Predicted"]
    assert lines == [f"{i + 1},{float(i)}" for i in range(50)]


def test_metrics_are_appended(spark, tmp_path):
    path = str(tmp_path / "m")
    S.append_metrics(spark, path, "one", {"mae": 1.0})
    S.append_metrics(spark, path, "two", {"mae": 2.0, "rmse": 3.0})
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {("one", "mae", 1.0), ("two", "mae", 2.0), ("two", "rmse", 3.0)}


def test_long_batches_are_decoded_in_pieces(monkeypatch):
    monkeypatch.setattr(M, "DECODED_ROWS", 4)
    batch = pa.record_batch([pa.array([str(i) for i in range(10)]), pa.array([PLAIN] * 9 + [None], pa.binary())], ["path", "content"])
    pieces = list(M._decode(iter([batch])))
    assert [p.num_rows for p in pieces] == [4, 4, 2]
    rows = pa.Table.from_batches(pieces).to_pylist()
    assert [r["path"] for r in rows] == [str(i) for i in range(10)]
    assert {r["sender"] for r in rows[:9]} == {"A <a@x.example>"} and rows[9]["sender"] is None


def test_many_folders_are_listed_in_few_tasks(spark):
    packed = M.packing_session(spark)
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    assert int(packed.conf.get(name)) == 4 * spark.sparkContext.defaultParallelism < int(spark.conf.get(name))
