import itertools
import random

import pytest

from postloom.llm.entities import MOST_LETTERS, SURNAME_RATIO, entity_pairs, fine_keys, identity, index_keys, lcs_ratio, link_senders, name_pairs, near, same_name, slip_keys, spelling_links
from postloom.operators.components import connected_components


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last, row[0] = 0, 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_lcs_against_a_table():
    r = random.Random(2)
    for _ in range(500):
        a, b = ("".join(r.choice("abcd") for _ in range(r.randint(0, 12))) for _ in range(2))
        want = 1.0 if a == b else 2 * lcs(a, b) / (len(a) + len(b)) if a and b else 0.0
        assert abs(lcs_ratio(a, b) - want) < 1e-12


GROUPS = [
    ["Gregory Hallwick <hallwick@a.example>", '"Hallwick, Gregory" <hallwick@a.example>', "hallwick@a.example", "Dr. Greg Hallwick <greg.h@b.example>", "G. Hallwick <hallwick@a.example>", "Gregory Hallwcik", "hallwick at a dot example", '"Gregory Hallwick - Stone Ferry" <hallwick@a.example>'],
    ["Martin Hallwick <mhallwick@a.example>", "HALLWICK MARTIN <MHALLWICK@A.EXAMPLE>"],
    ["Marta Hallwick <marta.hallwick@c.example>"],
    ["Dornfield Software Company <dornfield@a.example>", "DSC <dornfield@a.example>", "Dornfield Software Co.", "The Dornfield Software Company <info-dornfield@z.example>"],
    ["Dornfield Research Laboratories <dornfield@q.example>"],
    ["Ann Firstname <desk1@a.example>", "A. Firstname <desk1@a.example>"],
    ["Hugo Otherman <desk1@a.example>"],
    ["desk1@a.example"],
    ["Anonymous"],
    ["guest"],
]


def sender(raw):
    import re

    address = re.search(r"[\w.+-]+@[\w.-]+", raw.replace(" at ", "@").replace(" dot ", "."))
    name = re.sub(r"<.*>", "", raw).strip().strip('"') if "@" not in raw.split("<")[0] and " at " not in raw else None
    return raw, name or None, address.group().lower() if address else None


def test_groups(spark):
    rows, want = [], {}
    for g, group in enumerate(GROUPS):
        for raw in group:
            want[len(rows)] = g
            rows.append((len(rows), *sender(raw), "clash"))
    df = spark.createDataFrame(rows, "sender_id long, from_raw string, from_name string, from_email string, entity string")
    pairs = {(r.sender_a, r.sender_b) for r in entity_pairs(df).collect()}
    assert pairs == {(a, b) for a in want for b in want if a < b and want[a] == want[b]}
    # small blocks are refined and change nothing
    fine = {r.sender_id: r.entity for r in link_senders(df, block=3).collect()}
    assert {(a, b) for a in fine for b in fine if a < b and fine[a] == fine[b]} == pairs


def test_identities():
    assert identity("x", "Walter Binger0w", "bingerow_walter@x.example") == ("person", "walter", "bingerow", True)
    assert identity("frederick.hollow@x.example", None, "frederick.hollow@x.example") == ("person", "frederick", "hollow", True)
    assert identity(None, None, None)[0] == "none"


def test_components_against_brute_force(spark):
    r = random.Random(5)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(150)] + [(300 + i, 301 + i) for i in range(60)]
    nodes = list(range(400))
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = connected_components(spark.createDataFrame([(n,) for n in nodes], "node long"), spark.createDataFrame(edges, "a long, b long"))
    assert {x.node: x[1] for x in got.collect()} == {n: find(n) for n in nodes}


@pytest.mark.parametrize("rows", [[], [(1, None, None, None), (2, "", "", ""), (3, None, None, None), (None, "Ann Lee <a@b>", "Ann Lee", "a@b")], [(1, "x" * 100_000, "x" * 100_000, None), (2, "é\u200b ,,", ",", "@")]])
def test_nothing_to_link(spark, rows):
    df = spark.createDataFrame(rows, "sender_id long, from_raw string, from_name string, from_email string")
    assert entity_pairs(df).count() == 0
    assert link_senders(df).count() == sum(r[0] is not None for r in rows)


def test_words_one_slip_apart_share_a_key():
    words = ["".join(w) for n in range(5) for w in itertools.product("abc", repeat=n)]
    keys = {w: set(slip_keys(w)) for w in words}
    assert all(keys[a] & keys[b] for a in words for b in words if near(a, b, 0.0))
    assert len(slip_keys("ab" * 100_000)) > 1


def test_common_names_lose_no_slip(spark):
    r = random.Random(8)
    crowd = ["".join(r.choice("abcdefghijklmnoprstuvw") for _ in range(9)) for _ in range(300)]
    surnames = crowd + ["kelms", "eklms", crowd[0][:4] + crowd[0][5:], "xz" + crowd[1][2:]]
    names = [f"Gregory {w}" for w in surnames] + ["Walter Lee", "Wlater Lee", *(f"{w} Lee" for w in crowd[:250])]
    df = spark.createDataFrame([(i, n, n, None) for i, n in enumerate(names)], "sender_id long, from_raw string, from_name string, from_email string")
    want = {(300, 301), (0, 302), (304, 305)}
    assert {(x.sender_a, x.sender_b) for x in entity_pairs(df).collect()} == want
    for block in (1, 10_000):
        of = {x.sender_id: x.entity for x in link_senders(df, block=block).collect()}
        assert {(a, b) for a in of for b in of if a < b and of[a] == of[b]} == want


def random_names(n, seed):
    r = random.Random(seed)
    ends, firsts = ["wick", "ford", "ovich"], ["gregory", "grigory", "walter", "wolter", "anders", "joe", "joseph", "yusuf"]
    return [("person", r.choice(firsts), r.choice("bdkm") + r.choice(["al", "ol", "arl", "la"]) + r.choice(["", "t", "tt"]) + r.choice(ends)) for _ in range(n)] + [("org", "company", "dornfeld"), ("org", "company", "dornfled"), ("org", "press", "dornfeld")]


def test_pairs_are_those_of_brute_force_for_any_block(spark):
    names = sorted(set(random_names(150, 3)))
    def shared(a, b):
        return any(x[-4:] == y[-4:] for x in (a[1], *{"joe": ("joseph", "yusuf")}.get(a[1], ())) for y in (b[1], *{"joe": ("joseph", "yusuf")}.get(b[1], ()))) or a[2][-4:] == b[2][-4:]

    want = {(i, j) for (i, a), (j, b) in itertools.combinations(enumerate(names), 2) if a[0] == b[0] and same_name(a[0], *a[1:], *b[1:]) and (a[0] == "org" or shared(a, b))}
    df = spark.createDataFrame([(i, *n) for i, n in enumerate(names)], "id long, kind string, first string, last string").repartition(3)
    for block in (1, 5, 10**6):
        found = [tuple(x) for x in name_pairs(df, block).collect()]
        assert set(found) == want and len(found) == len(want)
    assert all(fine_keys(*names[i]) & fine_keys(*names[j]) and index_keys(*names[i]) & index_keys(*names[j]) for i, j in want)


def test_the_ratio_decides():
    assert near("hallwick", "halwicks", SURNAME_RATIO)  # a letter dropped and one added far apart
    assert near("hallwick", "hallwcik", SURNAME_RATIO) and not near("hallwick", "hallxyck", SURNAME_RATIO)
    assert not near("lee", "lea", SURNAME_RATIO)
    assert same_name("person", "gregory", "hallwick", "grgory", "halwick") and not same_name("person", "john", "hallwick", "joan", "hallwick")
    assert not near("a" * (MOST_LETTERS + 1), "a" * MOST_LETTERS, 0.1)


def test_short_forms_of_several_names(spark):
    def entities(*texts):
        df = spark.createDataFrame([(i, t, re_name(t), re_mail(t)) for i, t in enumerate(texts)], "sender_id long, from_raw string, from_name string, from_email string")
        of = {x.sender_id: x.entity for x in link_senders(df).collect()}
        return [of[i] for i in range(len(texts))]

    re_name = lambda t: t.split(" <")[0]
    re_mail = lambda t: t.split("<")[1].rstrip(">") if "<" in t else None
    a, b = entities("Joe Hallwick", "Joseph Hallwick <j.hallwick@a.example>")
    assert a == b
    a, b = entities("Joe Hallwick", "Yusuf Hallwick <y.hallwick@a.example>")
    assert a == b
    a, b, c = entities("Joe Hallwick <joseph.h@b.example>", "Yusuf Hallwick <y.hallwick@a.example>", "Joseph Hallwick <hallwick@c.example>")
    assert a == c != b
    a, b, c = entities("Ken Hallwick", "Kenji Hallwick <hallwick@a.example>", "Kenneth Hallwick <hallwick2@b.example>")
    assert b != c and a in (b, c)


def test_components_beyond_one_task(spark):
    r = random.Random(6)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(400 + i, 401 + i) for i in range(50)]
    args = spark.range(500).withColumnRenamed("id", "node"), spark.createDataFrame(edges, "a long, b long")
    assert {tuple(x) for x in connected_components(*args).collect()} == {tuple(x) for x in connected_components(*args, one_task=0).collect()}


def test_repeated_slips_are_judged_beside_the_other_spelling(spark):
    def names(word, count, host):
        return [(f"Gregory {word}", f"{c}q{host}@{host}.example") for c in "bdfghjkm"[:count]]

    # a slip under two addresses beside eight; two of two and eight of three may be two people; an address holds the last
    parts = [*names("Hallwick", 8, "a"), *names("Hallwcik", 2, "b"), *names("Dornfeld", 2, "c"), *names("Dronfeld", 2, "d"), *names("Bingrow", 8, "e"), *names("Bignrow", 3, "f"), *names("Stonehum", 8, "g"), ("Gregory Stonehnum", "stonehnum@h.example"), ("Gregory Stonehnum", "stonehnum@i.example")]
    df = spark.createDataFrame([(i, f"{n} <{e}>", n, e) for i, (n, e) in enumerate(parts)], "sender_id long, from_raw string, from_name string, from_email string")
    of = {parts[x.sender_id][0].split()[1]: x.entity for x in link_senders(df).collect()}
    assert of["Hallwick"] == of["Hallwcik"]
    assert len(set(of.values())) == 7


def test_spellings_none_of_which_is_sure_are_one(spark):
    # The best partners alone pair these off: a letter added scores more than a wrong one.
    row = ["Anders Hallwick", "Anders Hallwicks", "Anders Hallwock", "Anders Hallwocks"]
    # Two sure spellings, each with a slip of its own, and a spelling between the slips: it may not bridge them.
    sure = [("Bertil Stonehum", "stonehum@a.example"), ("Bertil Stonezem", "stonezem@b.example")]
    slips = ["Bertil Stonehumm", "Bertil Stonehem"]
    parts = [(n, None) for n in row] + sure + [(n, None) for n in slips]
    df = spark.createDataFrame([(i, f"{n} <{e}>" if e else n, n, e) for i, (n, e) in enumerate(parts)], "sender_id long, from_raw string, from_name string, from_email string")
    of = {parts[x.sender_id][0]: x.entity for x in link_senders(df).collect()}
    assert len({of[n] for n in row}) == 1
    assert of["Bertil Stonehum"] != of["Bertil Stonezem"] and of["Bertil Stonehumm"] == of["Bertil Stonehum"]


def test_spelling_links_keep_all_pairs_but_bridge_no_sure_ones(spark):
    def links(pairs, sure=()):
        rows = [(a, b, score, a in sure, a in sure, 1, b in sure, b in sure, 1) for a, b, score in pairs]
        df = spark.createDataFrame(rows, "a long, b long, score double, a_supported boolean, a_own boolean, a__n long, b_supported boolean, b_own boolean, b__n long")
        nodes = spark.createDataFrame([(n,) for n in sorted({x for p in pairs for x in p[:2]})], "node long")
        return {x.node: x.component for x in connected_components(nodes, spelling_links(df)).collect()}

    # two couples of best partners, joined by a pair that is nobody's best
    assert set(links([(1, 2, 1.9), (3, 4, 1.9), (2, 3, 1.8)]).values()) == {1}
    # 1 and 6 are sure: 2 leads to 1, 5 to 6; the free couple 3, 4 joins the better side only
    got = links([(1, 2, 1.9), (2, 3, 1.7), (3, 4, 1.9), (4, 5, 1.8), (5, 6, 1.9)], sure=(1, 6))
    assert got == {1: 1, 2: 1, 3: 3, 4: 3, 5: 3, 6: 3}
