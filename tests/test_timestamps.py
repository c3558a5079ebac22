from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from postloom.operators.timestamps import normalise_dates
from postloom.runtime import table

SITES = [("ny.example", "America/New_York"), ("utc.example", "UTC"), ("twice.example", "UTC"), ("twice.example", "Asia/Tokyo"), (None, "UTC")]
ZONES = [("PST", -480), ("BST", 60), ("XX", 0), ("XX", 60), (None, 5)]


def settle(spark, rows, sites=SITES, zones=ZONES):
    mails = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "pos long, date_raw string, from_email string")
    out = normalise_dates(mails, spark.createDataFrame(sites, "site_host string, tz_name string"), spark.createDataFrame(zones, "abbr string, offset_min int"))
    return [(r.utc_ms, r.date_status) for r in out.orderBy("pos").collect()]


def ms(*at, offset=0, milli=0):
    return int((datetime(*at, tzinfo=timezone.utc) - timedelta(minutes=offset)).timestamp() * 1000) + milli


CASES = [
    ("Mon, 14 Sep 1992 15:21:10 -0700", None, ms(1992, 9, 14, 15, 21, 10, offset=-420), "offset"),
    ("14 Sep 92 15:21 PST", None, ms(1992, 9, 14, 15, 21, offset=-480), "zone"),
    ("Tue Sep 15 13:10:40 1992", "a@utc.example", ms(1992, 9, 15, 13, 10, 40), "site"),
    ("Tue Sep 15 05:55:20 BST 1992", None, ms(1992, 9, 15, 5, 55, 20, offset=60), "zone"),
    ("1992-09-22T18:27:07.7039-07:00", None, ms(1992, 9, 22, 18, 27, 7, offset=-420, milli=703), "offset"),
    ("19921006T033124Z", None, None, "unknown_zone"),
    ("720520027736", None, 720520027736, "epoch"),
    ("718453410", None, 718453410000, "epoch"),
    ("2-OCT-1992 15:47:29.84", "x@ny.example", ms(1992, 10, 2, 15, 47, 29, offset=-240, milli=840), "site"),
    ("25.09.1992 10:46:28 PST", None, ms(1992, 9, 25, 10, 46, 28, offset=-480), "zone"),
    ("11/29/92 12:18 AM", "x@utc.example", ms(1992, 11, 29, 0, 18), "site"),
    ("Sunday, September 20, 1992 12:58 PM PST", None, ms(1992, 9, 20, 12, 58, offset=-480), "zone"),
    ("by h.example (sendmail) id AA1; Thu, 8 Oct 92 03:13:41 PST", None, ms(1992, 10, 8, 3, 13, 41, offset=-480), "zone"),
    ("Thu, 8 Oct 92 14:53:55 PST id AA39934 for list", None, ms(1992, 10, 8, 14, 53, 55, offset=-480), "zone"),
    ("Mi, 31 Mär 1993 06:38:03 +0100", None, ms(1993, 3, 31, 6, 38, 3, offset=60), "offset"),
    ("Sun, 25 Oct 1992 01:30:00", "x@ny.example", None, "ambiguous"),
    ("Sun, 5 Apr 1992 02:30:00", "x@ny.example", None, "nonexistent"),
    ("Thu, 31 Feb 1994 10:00:00 PST", None, None, "invalid"),
    ("Tue, 12 Jul 1995 25:61:07 -0400", None, None, "invalid"),
    ("Mon, 1 Jul 1996 10:00:00 +2500", None, None, "invalid"),
    ("Mon, 1 Jul 1996 10:00:00 XX", "x@utc.example", None, "unknown_zone"),
    ("Mon, 1 Jul 1996 10:00:00", "x@twice.example", None, "no_site"),
    ("Mon, 1 Jul 1996 10:00:00", None, None, "no_site"),
    ("08 Dec 1992", "x@utc.example", None, "no_time"),
    ("soon", None, None, "unparsed"),
    ("", None, None, "empty"),
    (None, None, None, "empty"),
    (" \t", None, None, "empty"),
    ("9" * 20_000, None, None, "unparsed"),
]


def test_cases(spark):
    got = settle(spark, [c[:2] for c in CASES])
    assert got == [c[2:] for c in CASES]


def test_wall_clocks_against_brute_force(spark):
    """Every half hour around the changes of the clock: an instant exactly where one and only one UTC time shows it."""
    zone = ZoneInfo("America/New_York")
    walls = [datetime(1992, 4, 4, 12) + timedelta(minutes=30 * i) for i in range(96)] + [datetime(1992, 10, 24, 12) + timedelta(minutes=30 * i) for i in range(96)]
    want = []
    for wall in walls:
        shown = [u for u in (wall + timedelta(minutes=30 * k) for k in range(-4, 25)) if u.replace(tzinfo=timezone.utc).astimezone(zone).replace(tzinfo=None) == wall]
        want.append(int(shown[0].replace(tzinfo=timezone.utc).timestamp() * 1000) if len(shown) == 1 else None)
    got = settle(spark, [(w.strftime("%Y-%m-%d %H:%M"), "x@ny.example") for w in walls])
    assert [g[0] for g in got] == want
    assert None in want


def test_empty_tables_and_clashing_names(spark):
    mails = spark.createDataFrame([(1, "718453410", None, 5, "x")], "pos long, date_raw string, from_email string, utc_ms int, _zone string").withColumn("_p", F.lit(1)).withColumn("_row", F.lit(2))
    none = spark.createDataFrame([], "site_host string, tz_name string")
    zones = spark.createDataFrame([], "abbr string, offset_min int")
    rows = normalise_dates(mails, none, zones).collect()
    assert rows[0].utc_ms == 718453410000 and rows[0]._zone == "x" and rows[0]._p == 1 and rows[0]._row == 2
    assert normalise_dates(mails.limit(0), none, zones).count() == 0


def test_every_kind_of_header_occurs(spark, folder):
    """Over the real table nearly all headers settle and nothing is lost."""
    mails = table(spark, folder, "emails")
    out = normalise_dates(mails, table(spark, folder, "sites"), table(spark, folder, "zone_names"))
    assert out.count() == mails.count()
    assert out.filter("utc_ms is not null").count() > 0.9 * mails.count()


@pytest.mark.parametrize("zone", ["Europe/Berlin", "UTC"])
def test_session_zone_does_not_matter(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert settle(spark, [c[:2] for c in CASES]) == [c[2:] for c in CASES]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_unknown_site_zone_has_a_status(spark):
    sites = [("odd.example", "Mars/Olympus"), ("worse.example", "'"), ("plus.example", "+02:00"), ("empty.example", "")]
    mails = spark.createDataFrame([(i, "3 May 1994 10:00:00", f"a@{h}") for i, (h, _) in enumerate(sites)], "pos long, date_raw string, from_email string")
    out = normalise_dates(mails, spark.createDataFrame(sites, "site_host string, tz_name string"), spark.createDataFrame([], "abbr string, offset_min int"))
    assert [r.date_status for r in out.orderBy("pos").collect()] == ["bad_site_zone", "bad_site_zone", "site", "bad_site_zone"]
