import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postloom import runtime
from postloom.functions.text import is_reply_subject, normalize_for_matching, normalize_subject
from postloom.operators import cleaning, matching, parsing, people, replies, spam, threads
from postloom.operators.ordered import next_after, place, running_sums
from postloom.operators.parsing import parse_date
from postloom.plans import pipeline
from postloom.sources import archive
from postloom.streaming.incremental import stream_parsed

MAIL = "pos long, id string, message_id string, in_reply_to string, subject string, from_email string, from_raw string, date_parsed string, date_raw string, has_pgp boolean, body string, file_year int, flags array<string>"


def mails(spark, rows):
    base = dict(id=None, message_id=None, in_reply_to=None, subject="", from_email=None, from_raw="", date_parsed=None, date_raw="", has_pgp=False, body="", file_year=1994, flags=[])
    names = [x.split()[0] for x in MAIL.split(", ")]
    return spark.createDataFrame([tuple({**base, "id": f"i{i}", **r, "pos": i + 1}[n] for n in names) for i, r in enumerate(rows)], MAIL)


def values(spark, texts, f):
    return [r.v for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", f(F.col("t")).alias("v")).orderBy("i").collect()]


def stages(spark, f):
    """(what f gives, the number of stages that its jobs have)."""
    context, group = spark.sparkContext, f"stages-{random.random()}"
    context.setJobGroup(group, group)
    try:
        out = f()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    jobs = context.statusTracker()
    return out, len({s for j in jobs.getJobIdsForGroup(group) for s in jobs.getJobInfo(j).stageIds})


def strip_prefixes(s):
    import re

    s, before = (s or "").strip(), None
    while s != before:
        before = s
        s = re.sub(r"^(?:(?:re|fwd|fw):\s*|\[[\w\s-]+\]\s*)", "", s, flags=re.I).strip()
    return s.lower()


def test_normalize_subject_against_a_loop(spark):
    r = random.Random(1)
    parts = ["Re:", "RE: ", "fwd:", " Fw:", "[list]", "[a b-c] ", "[x!]", "hello", " ", " ", "é", "re", ":", "\t"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 6))) for _ in range(2000)] + [None, ""]
    assert values(spark, texts, normalize_subject) == [strip_prefixes(t) for t in texts]


def test_reply_subjects(spark):
    assert values(spark, ["Re: a", " RE:b", "re: c", "Fwd: d", "FWD:e", "fw: f", None, ""], is_reply_subject) == [True, True, False, True, True, False, False, False]


def test_matching_key(spark):
    assert values(spark, ["  A  b,\tC! ", "x - y", None], normalize_for_matching) == ["a b c", "x  y", None]


RAW = """From: "Ann Example" <Ann@Example.net>
Subject: first
Subject: Re: last
 folded
X: one
no colon here
 lost
Message-ID: <m1@x>
In-Reply-To: <m0@x>
References: <r1@x> junk
 <r2@x>
Content-Type: text/html; charset=x
Date: Mon, 14 Feb 94 10:23:45 PST

body text of it

BEGIN PGP """


def test_parse_message(spark):
    row = parsing.parse_messages(spark.createDataFrame([(RAW, 1994), ("\n\nFrom: x\n\nonly body", 1994), ("", 0)], "raw string, file_year int")).collect()
    first, second, third = row
    assert (first.from_name, first.from_email, first.subject, first.message_id, first.in_reply_to) == ("Ann Example", "ann@example.net", "Re: last folded", "m1@x", "m0@x")
    assert (first.refs, first.content_type, first.date_parsed, first.has_pgp, first.flags) == (["r1@x", "r2@x"], "text/html", "1994-02-14T10:23:45-08:00", True, [])
    assert second.body == "From: x\n\nonly body" and second.in_reply_to is None
    assert third.flags == ["MISSING_HEADER: From", "MISSING_HEADER: Date", "EMPTY_BODY: body length = 0", "MISSING_HEADER: Message-ID", "MISSING_HEADER: Subject"]


SENDERS = [
    ("a@b.com (Name)", "Name", "a@b.com", 0), ('"x@y.zz" <x@y.zz>', "x@y.zz", "x@y.zz", 0), ("<a@b.com>", None, "a@b.com", 0), ("joe at site dot com", None, "joe@site.com", 1),
    ("joe [at] site[dot]com (Joe)", None, "joe@site.com", 1), ("joeNsite.example.com", None, "joe@site.example.com", 1), ("Matt", "Matt", None, 1), ("", None, None, 1), (None, None, None, 1),
]


def test_senders(spark):
    df = spark.createDataFrame([(i, s[0]) for i, s in enumerate(SENDERS)], "i int, r string")
    name, address, flags = parsing.sender(F.col("r"))
    got = [(r.r, r.n, r.a, len(r.f)) for r in df.select("i", "r", name.alias("n"), address.alias("a"), flags.alias("f")).orderBy("i").collect()]
    assert got == SENDERS


@pytest.mark.parametrize(
    ("raw", "iso"),
    [("Mon, 14 Feb 94 10:23:45 PST", "1994-02-14T10:23:45-08:00"), ("14 Feb 68 10:23:45 +0100", "2068-02-14T10:23:45+01:00"), ("14 Feb 69 10:23:45 XYZ", "1969-02-14T10:23:45"), ("Tue Sep  7 12:36:54 1999", "1999-09-07T12:36:54"), ("x sendmail id AA; Thu, 16 May 96 11:35:19 MST", "1996-05-16T11:35:19"), ("garbage", None), ("", None)],
)
def test_parse_date(raw, iso):
    assert parse_date(raw)[0] == iso


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=40))
def test_parse_date_never_fails(raw):
    iso, flags = parse_date(raw)
    assert iso is not None or flags


def test_archive_lines_and_round_trip(spark, tmp_path):
    d = archive.DELIMITER
    text = f"junk\nmore\n{d}\nA: 1\n\nb1\nb2\n{d}\n{d}\nC: 3\n\nlast\n"
    (tmp_path / "cyp-1993.txt").write_text(text)
    (tmp_path / "cyp-none.txt").write_bytes(f"{d}\nX: \xff\n\n".encode("latin-1") + b"end")
    rows = archive.read_messages(spark, str(tmp_path)).orderBy("source_file", "ordinal").collect()
    assert [(r.file_year, r.ordinal, r.true_line_number, r.raw.split("\n")[0]) for r in rows] == [(1993, 1, 4, "A: 1"), (1993, 2, 9, ""), (1993, 3, 10, "C: 3"), (0, 1, 2, "X: �")]
    assert text.split("\n")[rows[2].true_line_number - 1] == "C: 3"
    assert [r.line_number for r in rows] == [3, 9, 11, 1]


def test_json_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "é", 1994), (2, None, 1995)], "pos long, subject string, file_year int")
    archive.write_json(df, str(tmp_path / "a"), "file_year")
    got = archive.latest_of(spark, [str(tmp_path / "none"), str(tmp_path / "a")], "pos long, subject string, file_year int")
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "é", 1994), (2, None, 1995)]


def test_stream_equals_batch(spark, tmp_path):
    d = archive.DELIMITER
    for year in (1993, 1994):
        (tmp_path / f"cyp-{year}.txt").write_text(f"{d}\n{RAW}\n{d}\n{RAW.replace('m1@x', 'm2@x')}\n")
    query = stream_parsed(spark, str(tmp_path)).writeStream.format("memory").queryName("parsed_stream").trigger(availableNow=True).start()
    query.awaitTermination(60)
    got = sorted((r.file_year, r.message_id, r.from_email) for r in spark.table("parsed_stream").collect())
    batch = parsing.parse_messages(archive.read_messages(spark, str(tmp_path))).collect()
    assert got == sorted((r.file_year, r.message_id, r.from_email) for r in batch) and len(got) == 4


def test_cleaning(spark):
    rows = [
        dict(message_id="a", from_raw=" GNU ", flags=["NO_EMAIL_FOUND: 'GNU'", "MISSING_HEADER: Date"]),
        dict(message_id="b", from_raw="Anonymous", flags=["NO_EMAIL_FOUND: 'Anonymous'"]),
        dict(message_id="c", from_raw="?", flags=["NO_EMAIL_FOUND: '?'", "OBFUSCATED_EMAIL: x"]),
        dict(message_id="", flags=["MISSING_HEADER: Message-ID"]),
        dict(message_id="d", subject="MAKE MONEY now"),
        dict(message_id="e", from_email="12345678@x.com"),
        dict(message_id="f", subject=None, from_raw=None, flags=None),
    ]
    known = spark.createDataFrame([("gnu", "gnu@x.org"), (None, "z")], "from_key string, email string")
    out = {r.message_id: r for r in cleaning.clean(mails(spark, rows), known).collect()}
    assert set(out) == {"a", "b", "c", "f"}
    assert (out["a"].from_email, out["a"].flags) == ("gnu@x.org", ["MISSING_HEADER: Date"])
    assert out["b"].flags == ["ANONYMOUS_SENDER: 'Anonymous'"] and out["c"].flags == ["NO_EMAIL_FOUND: '?'"]
    s = cleaning.cleanup_stats(mails(spark, rows), known).collect()[0]
    assert (s.spam_removed, s.emails_fixed, s.known_entity_lookups, s.obfuscation_fixes, s.anonymous_kept, s.still_no_email) == (3, 2, 1, 1, 1, 1)


def test_spam_decisions(spark):
    rows = [
        dict(subject="Make money fast", from_email="a@x"),
        dict(body="this is not spam. act now! risk-free", from_email="b@x"),
        dict(body="<html><a href=x>click here</a> act now", from_email="c@x"),
        dict(body="<html><a href=x>click here</a>", from_email="d@x"),
        dict(body="act now", from_email="1234567@num.com"),
        dict(body="act now", from_email="1234567@aol.com"),
        dict(subject=None, body=None, from_email=None),
        *[dict(subject="make money", from_email="busy@x")] * 6,
        *[dict(subject="make money", from_email=None)] * 7,
    ]
    out = [(r.pos, r.is_spam, r.reasons) for r in spam.classify(mails(spark, rows)).orderBy("pos").collect()]
    assert [x[1] for x in out] == [True, True, True, False, True, False, False, *[False] * 6, *[True] * 7]
    assert out[1][2] == ["spam_body:not_spam_disclaimer", "spam_body:act_now", "spam_body:risk_free"]
    assert [(r.pos, r.is_spam, r.reasons) for r in spam.classify(mails(spark, rows), most_senders=0).orderBy("pos").collect()] == out
    assert {r.file_year: (r.n_spam, r.n_mails) for r in spam.spam_by_year(spam.classify(mails(spark, rows))).collect()} == {1994: (11, 20)}
    assert {r.reason: r.n for r in spam.reason_counts(spam.classify(mails(spark, rows))).collect()}["spam_subject"] == 8
    assert spam.spam_review(spam.classify(mails(spark, rows))).count() == 11


def test_disguises_in_the_order_of_the_original(spark):
    df = spark.createDataFrame([("joe [at] site[dot]com",), ("joe at site dot com",), ("pat at site dot com",)], "r string")
    assert [r.a for r in df.select(parsing.sender(F.col("r"), parsing.DISGUISES_IN_ORDER)[1].alias("a")).collect()] == [None, "joe@site.com", None]


def day(n, h=0):
    return f"1994-01-{n:02d}T{h:02d}:00:00"


def test_time_anchors(spark):
    days = [1, 2, 4, 5, 6, 9, 20, 23, 24]
    rows = [dict(message_id=f"m{d}", subject="a topic", date_parsed=day(d)) for d in days] + [dict(message_id="u", subject="a topic"), dict(message_id="s", subject="abc", date_parsed=day(1))]
    got = {r.pos: (r.parent_id, r.time_proximity_days) for r in matching.match_by_time(replies.classify_orphans(replies.link_replies(mails(spark, rows)))).collect()}
    assert got == {2: ("m1", 1), 3: ("m1", 3), 5: ("m5", 1), 8: ("m20", 3)}


def test_two_orphans_that_choose_each_other(spark):
    rows = [dict(message_id="a", subject="Re: t", date_raw="x"), dict(message_id="b", subject="Re: t", date_raw="y"), dict(message_id="c", subject="Re: lone")]
    state = replies.classify_orphans(replies.link_replies(mails(spark, rows)))
    found = matching.match_by_subject(state)
    assert {r.pos: r.parent_id for r in found.collect()} == {1: "b", 2: "a"}
    assert [(r.pos, r.parent_id) for r in matching.drop_loops(state, found).collect()] == [(1, "b")]
    assert [(r.pos, r.parent_id) for r in matching.match_by_subject(state, loop_free=True).collect()] == [(1, "b")]


def test_only_the_closing_link_goes(spark):
    rows = [dict(message_id=m) for m in "cdef"] + [dict(message_id="x", in_reply_to="y"), dict(message_id="y", in_reply_to="x"), dict(message_id="z")]
    state = replies.classify_orphans(replies.link_replies(mails(spark, rows)))
    links = spark.createDataFrame([(1, "d"), (2, "c"), (3, "d"), (4, "e"), (7, "x")], "pos long, parent_id string")
    assert sorted(r.pos for r in matching.drop_loops(state, links).collect()) == [1, 3, 4, 7]  # one of the loop c, d; what hangs below loops stays


def rounds(rows):
    """Brute force: every orphan's best candidate; the latest link of each loop gives way to the next best, until no loop is left."""
    from datetime import datetime

    when = lambda r: datetime.fromisoformat(r["date_parsed"][:19]) if r["date_parsed"] else None
    stands = {r["message_id"]: r for r in rows if r["message_id"]}
    lists = {}
    for r in rows:
        if r["orphan_status"] != "orphan_reply" or not r["normalized_subject"]:
            continue
        own = []
        for c in rows:
            if c["normalized_subject"] != r["normalized_subject"] or c["id"] == r["id"] or not c["message_id"] or (when(r) and when(c) and when(c) >= when(r)):
                continue
            score = 10 * (c["orphan_status"] == "true_root") + 5 * bool(c["children"]) + 3 * bool(c["parent_id"])
            if when(r) and when(c):
                gap = (when(r) - when(c)).total_seconds()
                score += 5 if gap < 86400 else 3 if gap < 604800 else 1 if gap < 2592000 else 0
            own.append((-score, c["date_parsed"] or c["date_raw"] or "", c["pos"], c["message_id"]))
        lists[r["pos"]] = sorted(own)
    while True:
        link = {p: x[0][3] for p, x in lists.items() if x}
        up = {r["message_id"]: link.get(r["pos"], r["parent_id"]) for r in stands.values()}
        bad = set()
        for r in stands.values():
            ring, at = [], up[r["message_id"]]
            while at in up and at != r["message_id"] and at not in ring:
                ring.append(at)
                at = up[at]
            fresh = [stands[m]["pos"] for m in [*ring, r["message_id"]] if stands[m]["pos"] in link]
            if at == r["message_id"] and fresh:
                bad.add(max(fresh))
        if not bad:
            return {p: (x[0][3], -x[0][0]) for p, x in lists.items() if x}
        for p in bad:
            lists[p].pop(0)


def random_archive(r, n, blind):
    rows = []
    for i in range(n):
        date = f"1994-{r.randint(1, 4):02d}-{r.randint(1, 28):02d}T{r.randint(0, 23):02d}:00:00" if r.random() > blind else None
        rows.append(dict(message_id=f"m{i}" if r.random() < 0.95 else "", in_reply_to=f"m{r.randrange(n)}" if r.random() < 0.2 else None, subject=r.choice(["Re: ", "Re: ", ""]) + f"t{r.randint(0, 5)}", date_parsed=date, date_raw=f"raw{r.randint(0, 9)}"))
        if r.random() < 0.1:
            rows.append({**rows[-1], "id": f"i{len(rows) - 1}"})
    return rows


@pytest.mark.parametrize("blind", [0.2, 0.8])
def test_loop_free_matching_against_brute_force(spark, blind):
    state = replies.classify_orphans(replies.link_replies(mails(spark, random_archive(random.Random(int(blind * 10)), 90, blind)))).cache()
    plain = [x.asDict() for x in state.orderBy("pos").collect()]
    parents = {y["parent_id"] for y in plain}
    for x in plain:
        x["children"] = x["message_id"] in parents and x["message_id"]
    links, rejected = matching.match_with_rejections(state)
    assert {x.pos: (x.parent_id, x.match_score) for x in links.collect()} == rounds(plain)
    assert {(x.pos, x.parent_id) for x in rejected.collect()}.isdisjoint((x.pos, x.parent_id) for x in links.collect())


@pytest.mark.parametrize("spread", [False, True])
def test_next_after_and_running_sums_against_loops(spark, spread):
    """spread: small ranges are kept apart, so that groups cross the borders of partitions."""
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(not spread).lower())
    spark.conf.set("spark.sql.shuffle.partitions", "23" if spread else "4")
    try:
        next_after_and_running_sums(spark)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def next_after_and_running_sums(spark):
    r = random.Random(9)
    rows = [(r.choice("aab"), r.randint(0, 30), i) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, ts long, pos long").repartition(7)
    cells = df.filter("pos % 3 = 0").select("g", place(F.col("ts"), F.lit(""), F.col("pos")).alias("at"), F.struct("ts", "pos").alias("cell"))
    probes = df.filter("pos % 3 <> 0").select("g", place(F.col("ts")).alias("at"), F.col("pos").alias("probe"))
    got = {x.probe: (x.cell.ts, x.cell.pos) for x in next_after(probes, cells, ["g"]).collect()}
    want = {p: min((t2, p2) for g2, t2, p2 in rows if p2 % 3 == 0 and g2 == g and t2 >= t) for g, t, p in rows if p % 3 and any(p2 % 3 == 0 and g2 == g and t2 >= t for g2, t2, p2 in rows)}
    assert got == want
    sums = running_sums(df, ["g"], ["ts", "pos"], {"before": F.col("ts"), "n": F.lit(1)})
    for x in sums.collect():
        above = [t for g, t, p in rows if g == x.g and (t, p) < (x.ts, x.pos)]
        assert (x.before, x.n) == (sum(above), len(above))
    assert running_sums(df.limit(0), ["g"], ["ts"], {"n": F.lit(1)}).count() == next_after(probes.limit(0), cells, ["g"]).count() == 0


def test_related_subjects(spark):
    texts = ["a", "ab", "xaby", "b", "key", "monkey", "Ää", ""]
    one = lambda n: spark.createDataFrame([(t,) for t in texts], f"{n} string")
    got = {tuple(x) for x in matching.related_subjects(one("mine"), one("theirs")).collect()}
    assert got == {(a, b) for a in texts for b in texts if a and b and a != b and (a in b or b in a)}


def in_order(rows):
    """Brute force: a plain loop over mails in archive order."""
    from datetime import datetime

    when = lambda r: datetime.fromisoformat(r["date_parsed"][:19]) if r["date_parsed"] else None
    known = {r["message_id"]: r for r in rows if r["message_id"]}
    made = {}
    for r in rows:
        if r["orphan_status"] != "orphan_reply" or not r["normalized_subject"]:
            continue
        best, top = None, -1
        for c in sorted((x for x in rows if x["normalized_subject"] == r["normalized_subject"]), key=lambda x: x["date_parsed"] or x["date_raw"] or ""):
            if c["id"] == r["id"] or (when(r) and when(c) and when(c) >= when(r)):
                continue
            seen, at, loop = set(), c["message_id"], False
            while at:
                if at == r["message_id"] or at in seen:
                    loop = True
                    break
                seen.add(at)
                at = known[at]["parent_id"] if at in known else None
            if loop:
                continue
            score = 10 * (c["orphan_status"] == "true_root") + 5 * bool(c["children"]) + 3 * bool(c["parent_id"])
            if when(r) and when(c):
                gap = (when(r) - when(c)).total_seconds()
                score += 5 if gap < 86400 else 3 if gap < 604800 else 1 if gap < 2592000 else 0
            if score > top:
                best, top = c, score
        if best:
            r["parent_id"], r["orphan_status"] = best["message_id"], "matched_by_subject"
            best["children"].append(r["message_id"])
            made[r["pos"]] = (best["message_id"], top)
    return made


@pytest.mark.parametrize("seed", range(3))
def test_matching_in_order_against_a_loop(spark, seed):
    r = random.Random(seed)
    rows = []
    for i in range(150):
        date = f"1994-{r.randint(1, 4):02d}-{r.randint(1, 28):02d}T{r.randint(0, 23):02d}:00:00" if r.random() < 0.8 else None
        rows.append(dict(message_id=f"m{i}", in_reply_to=f"m{r.randrange(i)}" if i and r.random() < 0.4 else None, subject=r.choice(["Re: ", ""]) + f"t{r.randint(0, 5)}", date_parsed=date, date_raw=f"raw{r.randint(0, 9)}"))
    state = replies.classify_orphans(replies.link_replies(mails(spark, rows)))
    plain = [x.asDict() for x in state.orderBy("pos").collect()]
    for x in plain:
        x["children"] = [y["message_id"] for y in plain if y["parent_id"] == x["message_id"]]
    got = {x.pos: (x.parent_id, x.match_score) for x in matching.match_in_order(state).collect()}
    assert got == in_order(plain) and got
    with pytest.raises(ValueError):
        matching.match_in_order(state, most=3)


def test_duplicates_and_threads(spark):
    rows = [dict(message_id="a", from_email="x@y", date_parsed=day(1)), dict(message_id="a", from_email="x@y", date_parsed=day(1)), dict(message_id="b", in_reply_to="a", from_email="z@y", date_parsed=day(2)), dict(message_id="", in_reply_to="a"), dict(message_id="l", in_reply_to="l")]
    members = threads.thread_members(replies.classify_orphans(replies.link_replies(mails(spark, rows))))
    out = {r.root_pos: (r.message_count, r.participant_count, r.depth) for r in threads.build_threads(members).collect()}
    assert out == {2: (2, 2, 1), 4: (1, 0, 0)}


def test_people(spark):
    rows = [dict(message_id="r", from_email="root@x"), dict(message_id="k", in_reply_to="r", from_email="old-eric@x"), dict(message_id="g", in_reply_to="k", from_email="q@x"), dict(message_id="s", in_reply_to="r", from_email="w@x"), dict(message_id="t", from_email=None)]
    table = spark.createDataFrame([(1, "Other", "zzz"), (2, "Eric", " ERIC@x ")], "ord int, person string, pattern string")
    members = threads.thread_members(replies.classify_orphans(replies.link_replies(mails(spark, rows))))
    assert {r.pos for r in people.people_closure(members, table).collect()} == {1, 2, 3}
    assert [tuple(r) for r in people.people_stats(members, table).collect()] == [("Eric", 1, 1)]
    with pytest.raises(ValueError):
        people.attribute(members, spark.range(people.MOST_PATTERNS + 1).selectExpr("id as ord", "'p' as person", "cast(id as string) as pattern"))


def test_empty_tables(spark):
    none = mails(spark, [])
    state = replies.classify_orphans(replies.link_replies(none))
    for df in (matching.match_by_subject(state), matching.match_by_quotes(state), matching.match_by_time(state), threads.build_threads(threads.thread_members(state)), spam.classify(none), replies.fanout_histogram(none), replies.widest_parent(none)):
        assert df.count() == 0
    assert replies.link_stats(none).collect()[0].max_children == 0


def long_way_out(n):
    """Two mails without a date whose subject holds n replies to each of them before the mail that closes no loop."""
    rows = [dict(message_id=f"top{k}", subject="Re: t", date_raw="~") for k in range(2)]
    rows += [dict(message_id=f"m{i}", in_reply_to=f"top{i % 2}", subject="Re: t", date_raw=f"{i:03d}") for i in range(n)]
    return rows + [dict(message_id="last", subject="t", date_raw="~~"), dict(message_id="out", subject="Re: t", date_raw="~~~")]


def test_loops_are_broken_in_few_steps_whatever_the_rounds(spark, monkeypatch):
    steps = []
    monkeypatch.setattr(matching, "cut", lambda df, _cut=matching.cut: steps.append(1) or _cut(df))
    rows = long_way_out(30)
    for r in rows:
        r["subject"] = r["subject"] if r["message_id"] != "last" else "Re: t"  # no root, so that replies come first
    state = replies.classify_orphans(replies.link_replies(mails(spark, rows))).cache()
    links, rejected = matching.match_with_rejections(state)
    got = {r.pos: (r.parent_id, r.match_score) for r in links.collect()}, sorted((r.pos, r.parent_id) for r in rejected.collect())
    assert len(got[1]) >= 30 and len(steps) < 20
    plain = [x.asDict() for x in state.orderBy("pos").collect()]
    parents = {y["parent_id"] for y in plain}
    for x in plain:
        x["children"] = x["message_id"] in parents and x["message_id"]
    assert got[0] == rounds(plain)
    assert matching.link_kinds(state, links).agg(F.sum("n")).first()[0] == len(got[0])
    row = matching.subject_match_stats(state).first()
    assert (row.orphans_matched, row.cycles_prevented) == (len(got[0]), len(got[1]))


def test_all_links_in_few_steps(spark, monkeypatch):
    steps = []
    monkeypatch.setattr(matching, "cut", lambda df, _cut=matching.cut: steps.append(1) or _cut(df))
    rows = [{**r, "subject": "Re: t"} for r in long_way_out(30)]
    state = pipeline.linked_mails(mails(spark, rows))
    assert {r.orphan_status: r["count"] for r in state.groupBy("orphan_status").count().collect()} == {"has_parent": 30, "matched_by_subject": 3, "orphan_reply": 1}
    assert len(steps) < 60
    assert [r.message_count for r in pipeline.archive_threads(state)[1].collect()] == [34]


def test_matching_in_order_of_many_mails(spark):
    """More mails under one subject than were accepted once."""
    n = 500_010
    late = F.col("pos") > n - 3
    rows = spark.range(1, n + 1).select(F.col("id").alias("pos"), F.col("id").cast("string").alias("id"), F.col("id").cast("string").alias("message_id"))
    rows = rows.withColumns({"parent_id": F.lit(None).cast("string"), "normalized_subject": F.lit("t"), "orphan_status": F.when(late, "orphan_reply").otherwise("true_root"), "date_parsed": F.lit(None).cast("string"), "date_raw": F.lpad((n - F.col("pos")).cast("string"), 7, "0")})
    got = matching.match_in_order(rows).orderBy("pos").collect()
    # The earliest date string wins at first, then the mail that has a child.
    assert [tuple(r) for r in got] == [(n - 2 + k, str(n - 3), 10 if k == 0 else 15, None, "to_root") for k in range(3)]


def test_a_written_state_is_measured_without_an_exchange(spark):
    many = runtime.cut(spark.range(1000, numPartitions=8).withColumn("t", F.lit("x")))
    assert stages(spark, lambda: runtime.is_small(many, 1000, written=True)) == (True, 1)
    assert not runtime.is_small(many, 999, written=True) and not runtime.is_small(many, 1000, 8999, written=True) and runtime.is_small(many, 1000, 9000, written=True)
    assert runtime.is_small(runtime.cut(many.filter("id < 0")), 0, written=True)


def test_bodies_are_read_without_a_join(spark, monkeypatch):
    line = "a line that is long enough to be quoted by others"
    state = mails(spark, [dict(message_id="a", subject="s", body=f"{line}\nand more of it, so that the body is long enough"), dict(message_id="b", subject="t", body=f"> {line}")])
    plans, of = [], matching.body_lines
    monkeypatch.setattr(matching, "body_lines", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or of(df))
    got = {r.message_id: (r.parent_id, r.orphan_status) for r in pipeline.linked_mails(state).collect()}
    assert got == {"a": (None, "true_root"), "b": ("a", "matched_by_quote")}
    assert len(plans) == 1 and "Join" not in plans[0]


def test_state_is_freed_after_each_kind_of_link(spark, monkeypatch):
    freed = []
    monkeypatch.setattr(pipeline, "release", lambda session: freed.append(session))
    state = mails(spark, [dict(message_id="a", subject="s"), dict(message_id="b", subject="Re: s")])
    assert {r.orphan_status: r["count"] for r in pipeline.linked_mails(state).groupBy("orphan_status").count().collect()} == {"true_root": 1, "matched_by_subject": 1}
    assert freed == [spark] * 3


def test_subject_stats_measure_written_sides_only(spark, monkeypatch):
    asked, of = [], runtime.is_small
    monkeypatch.setattr(runtime, "is_small", lambda df, rows, most_bytes, written=False: asked.append(written) or of(df, rows, most_bytes, written))
    rows = [dict(message_id="a", subject="Re: t", date_raw="x"), dict(message_id="b", subject="Re: t", date_raw="y")]
    got = matching.subject_match_stats(replies.classify_orphans(replies.link_replies(mails(spark, rows)))).first()
    assert (got.orphans_before, got.orphans_matched, got.cycles_prevented) == (2, 1, 1)
    assert asked and all(asked)
