from pyspark.sql import Window
from pyspark.sql import functions as F

from postloom.operators import parsing
from postloom.plans.pipeline import archive_threads, clean_and_filter, linked_mails
from postloom.sources import archive


def message(mid, sender, subject, day, body, reply=None):
    head = f"From: {sender}\nDate: {day} Feb 1994 10:00:00 +0000\nSubject: {subject}\nMessage-ID: <{mid}>\n" + (f"In-Reply-To: <{reply}>\n" if reply else "")
    return f"{archive.DELIMITER}\n{head}\n{body}\n"


def test_archive_text_to_threads(spark, tmp_path):
    texts = [
        message("a@x", "Ann <ann@x.org>", "Keys", 1, "where are the keys kept today"),
        message("b@x", "GNU", "Re: Keys", 2, "under the mat as always", "a@x"),
        message("c@x", "Bob <bob@x.org>", "Re: Keys", 3, "no longer under the mat", "b@x"),
        message("s@x", "Spammer <s@x.org>", "Make money fast", 4, "act now and be rich"),
        message("l@x", "Cy <cy@x.org>", "Re: Keys", 5, "a reply to a lost mail", "gone@x"),
        message("z@x", "Dee <dee@x.org>", "Other matter", 6, "something else entirely here"),
    ]
    (tmp_path / "cyp-1994.txt").write_text("".join(texts))
    order = Window.orderBy("source_file", "ordinal")  # six rows
    raw = archive.read_messages(spark, str(tmp_path)).withColumn("pos", F.row_number().over(order).cast("long"))
    known = spark.createDataFrame([("gnu", "gnu@x.org")], "from_key string, email string")
    kept = clean_and_filter(parsing.parse_messages(raw), known)
    assert {r.message_id: r.from_email for r in kept.collect()} == {"a@x": "ann@x.org", "b@x": "gnu@x.org", "c@x": "bob@x.org", "l@x": "cy@x.org", "z@x": "dee@x.org"}
    members, threads = archive_threads(linked_mails(kept))
    root = {r.message_id: r.root for r in members.collect()}
    assert root["a@x"] == root["b@x"] == root["c@x"] == root["l@x"]
    assert root.get("z@x") != root["a@x"] and "s@x" not in root
    assert {r.message_count for r in threads.collect() if r.root_pos == root["a@x"]} == {4}


def test_command_line(spark, tmp_path):
    from postloom.__main__ import main

    source = tmp_path / "in"
    source.mkdir()
    (source / "cyp-1994.txt").write_text(message("a@x", "Ann <ann@x.org>", "Keys", 1, "where are the keys kept today") + message("b@x", "GNU", "Re: Keys", 2, "under the mat as always", "a@x"))
    (source / "cyp-1995.txt").write_text(message("c@x", "Bob <bob@x.org>", "Re: Keys", 3, "no longer under the mat", "b@x"))
    spark.createDataFrame([("gnu", "gnu@x.org")], "from_key string, email string").write.parquet(str(tmp_path / "known"))
    main(["parse", str(source), str(tmp_path / "parsed")])
    records = spark.read.parquet(str(tmp_path / "parsed/emails"))
    assert [r.message_id for r in records.orderBy("pos").collect()] == ["a@x", "b@x", "c@x"]
    main(["clean", str(tmp_path / "parsed/emails"), str(tmp_path / "known"), str(tmp_path / "clean")])
    main(["thread", str(tmp_path / "clean/emails"), str(tmp_path / "threads")])
    rows = spark.read.parquet(str(tmp_path / "threads/threads")).collect()
    assert [(r.message_count, r.rank) for r in rows] == [(3, 1)]
    main(["parse", str(source), str(tmp_path / "lines"), "--json"])
    assert spark.read.json(str(tmp_path / "lines/emails")).count() == 3
