"""Links the spellings under which one person or organisation appears.

A sender row is parsed into an identity: given name and surname of a person (order, titles, middle initials,
affiliations, digits written for letters and short forms are taken out; a misspelt surname is put right by the
surname in the address), or the words of an organisation. A short form that may stand for several names is kept
and may mean any of them.

Distinct identities are indexed by the suffix of one name token, always refined by the other field (its whole
word and the word less each letter): a suffix alone is common in every large table, a refined one is not. A
refined suffix of more than BLOCK identities is discarded, and its identities are compared under both words less
each letter instead, so no pair is lost and the links do not depend on BLOCK. Pairs are judged by their longest
common subsequence: its ratio must be high, and of either word one letter at most may lie outside. So a pair may
differ in both fields, if some suffix is shared. Two spellings that both stand on their own (by an address or by
repetition) stay apart.

Rows also belong together through one address, unless several people use it: an address is shared if any full
name on it cannot be the same as its most frequent one. The classes are the connected components of all links.

Defined results: a row with a NULL key is left out; a row without any name or address of its own (NULL, empty, a bare word, a shared address alone)
is a class of its own; a word of more than MOST_LETTERS letters is linked to the same word only; repeated rows are
linked; extra columns are ignored; an empty table has no classes.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.llm.names import AMBIGUOUS, GIVEN, NICKNAMES, ORG_SHORT, ORG_WORDS, TITLES
from postloom.operators.components import connected_components
from postloom.runtime import broadcast_if_small, cut

#: Letters of the suffixes of the index; a shorter word is its own suffix.
LEAST_SUFFIX = 4
#: Identities of a refined suffix that are all compared; above that it is discarded for a finer index.
BLOCK = 100
#: Longer words are no names.
MOST_LETTERS = 64
#: Modulus and base of the hashes of slip keys.
_PRIME, _BASE = (1 << 61) - 1, 1_000_003
#: A spelling no address holds is a slip of one that comes from so many times its sources, however often it recurs.
MANY = 4
SURNAME_RATIO = 0.8
GIVEN_RATIO = 0.78

_DIGIT_LETTERS = str.maketrans("013457", "oieast")
_PAREN = re.compile(r"\(([^()]*)\)\s*$")
_OBFUSCATED = re.compile(r"\bat\b|\[at\]|\(at\)|@", re.I)


def lcs_ratio(a: str, b: str) -> float:
    """2 x the longest common subsequence / both lengths, by bit-parallel dynamic programming."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & masks.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return 2 * (len(a) - row.bit_count()) / (len(a) + len(b))


def near(a: str, b: str, least: float) -> bool:
    """Whether the longest common subsequence leaves out one letter of either word at most, and its ratio is high."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1 or max(len(a), len(b)) > MOST_LETTERS:
        return False
    ratio = lcs_ratio(a, b)
    return ratio >= least and round(ratio * (len(a) + len(b)) / 2) >= max(len(a), len(b)) - 1


def _words(name: str) -> list[str]:
    name = unicodedata.normalize("NFKC", name).strip(" \"'\t")
    name = re.split(r"\s+[-–/|]\s+", name)[0]
    if name.count(",") == 1:
        last, first = name.split(",")
        name = f"{first} {last}"
    out = []
    for w in re.split(r"[\s,]+", name.replace("_", " ")):
        w = w.strip(".\"'()").lower()
        if w and any(c.isalpha() for c in w) and w not in TITLES:
            out.append(w.translate(_DIGIT_LETTERS) if any(c.isdigit() for c in w) and re.fullmatch(r"[a-z]+\d[a-z]*|\d[a-z]+", w) else w)
    return out


def _local_parts(email: str) -> list[str]:
    local = email.split("@")[0].split("+")[0]
    return [p for p in re.split(r"[._\-0-9]+", local) if p]


def _full_form(given: str, parts: list[str]) -> str:
    """The name a short form stands for; one that may stand for several is settled by the address or kept."""
    told = [g for g in AMBIGUOUS.get(given, ()) if g in parts]
    return told[0] if len(told) == 1 else NICKNAMES.get(given, given)


def _right_spelling(word: str, parts: list[str]) -> str | None:
    """The spelling of a surname in an address: the suffix of a part that is nearest to the word as typed."""
    best, found = 0.0, None
    for part in parts:
        for n in range(max(4, len(word) - 2), len(word) + 3):
            if n <= len(part) and (n == len(part) or len(part) - n in (1, 3)):
                ratio = lcs_ratio(part[-n:], word)
                if ratio > best:
                    best, found = ratio, part[-n:]
    return found if best >= SURNAME_RATIO else None


@lru_cache(100_000)
def identity(raw: str | None, name: str | None, email: str | None) -> tuple[str, str, str, bool]:
    """(kind, first, last, supported): kind is person, initial, org, short (an acronym or login) or none."""
    text = name
    if not text and raw:
        inside = _PAREN.search(raw)
        text = inside.group(1) if inside else "" if _OBFUSCATED.search(raw) or "<" in raw else raw
    words = _words(text or "")
    parts = _local_parts(email or "")
    if len([w for w in words if len(w) > 1]) < 1 or (len(words) == 1):
        known = [p for p in parts if p in GIVEN or p in NICKNAMES or p in AMBIGUOUS]
        if not words and len(parts) == 2 and len(known) == 1:  # given.surname or surname_given
            other = next(p for p in parts if p is not known[0])
            if len(other) >= 4:
                return "person", _full_form(known[0], parts), other, True
        return ("short", "", words[0], False) if words and email else ("none", "", "", False)
    if any(w in ORG_WORDS or w in ORG_SHORT for w in words):
        full = [x for w in words if w not in ("the", "and", "of") for x in [ORG_SHORT.get(w, w)]]
        rest = [w for w in full if w in ORG_WORDS]
        core = next((w for w in full if w not in ORG_WORDS), "")
        right = _right_spelling(core, parts) if core else None
        return "org", " ".join(sorted(rest)), right or core, right is not None
    long = [w for w in words if len(w) > 1]
    first_initial = len(words[0]) == 1
    if len(long) == 1:
        last, given = long[0], next((w for w in words if len(w) == 1), "")
        right = _right_spelling(last, parts)
        return "initial", given, right or last, right is not None
    is_given = lambda w: w in GIVEN or w in NICKNAMES or w in AMBIGUOUS
    given, last = (long[-1], long[0]) if is_given(long[-1]) and not is_given(long[0]) else (long[0], long[-1])
    if not is_given(given) and not is_given(last) and not first_initial:
        near = [max((lcs_ratio(w, g) for g in GIVEN if abs(len(g) - len(w)) < 3), default=0.0) for w in (given, last)]
        if near[1] > near[0] and near[1] >= GIVEN_RATIO:
            given, last = last, given
    right = _right_spelling(last, parts)
    return "person", _full_form(given, parts), right or last, right is not None


def _identities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raws, names, emails = (batch.column(i).to_pylist() for i in (1, 2, 3))
        found = [identity(r, n, e.lower() if e else None) for r, n, e in zip(raws, names, emails)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([e.lower() if e else None for e in emails], pa.string()), *(pa.array([x[i] for x in found], t) for i, t in enumerate((pa.string(), pa.string(), pa.string(), pa.bool_())))], ["_key", "email", "kind", "first", "last", "supported"])


def _forms(given: str) -> tuple[str, ...]:
    return (given, *AMBIGUOUS.get(given, ()))


def same_given(a: str, b: str) -> bool:
    if a == b or b in AMBIGUOUS.get(a, ()) or a in AMBIGUOUS.get(b, ()):
        return True
    return len(a) > 3 and len(b) > 3 and not (a in GIVEN and b in GIVEN) and near(a, b, GIVEN_RATIO)


def same_name(kind: str, first_a: str, last_a: str, first_b: str, last_b: str) -> bool:
    """Whether two identities of one kind may be spellings of one name."""
    firsts = same_given(first_a, first_b) if kind == "person" else first_a == first_b
    return firsts and near(last_a, last_b, SURNAME_RATIO)


def _alike_given(a: str, b: str) -> bool:
    return same_given(a, b) or (len(a) > 3 and len(b) > 3 and not (a in GIVEN and b in GIVEN) and lcs_ratio(a, b) >= GIVEN_RATIO)


def can_be_same(kind_a: str, first_a: str, last_a: str, kind_b: str, first_b: str, last_b: str) -> bool:
    """Whether two names on one address can mean one entity."""
    if "short" in (kind_a, kind_b) or "none" in (kind_a, kind_b):
        return True
    if kind_a == "org" or kind_b == "org":
        return kind_a == kind_b and lcs_ratio(last_a, last_b) >= 0.7
    if "initial" in (kind_a, kind_b):
        return lcs_ratio(last_a, last_b) >= 0.7 and first_a[:1] == first_b[:1]
    return (_alike_given(first_a, first_b) or first_a[:3] == first_b[:3]) and lcs_ratio(last_a, last_b) >= 0.7


@F.pandas_udf(T.BooleanType())
def _fits(kind_a: pd.Series, first_a: pd.Series, last_a: pd.Series, kind_b: pd.Series, first_b: pd.Series, last_b: pd.Series) -> pd.Series:
    return pd.Series([can_be_same(*x) for x in zip(kind_a, first_a, last_a, kind_b, first_b, last_b)], dtype=bool)


@F.pandas_udf(T.DoubleType())
def _score(first_a: pd.Series, last_a: pd.Series, sure_a: pd.Series, first_b: pd.Series, last_b: pd.Series, sure_b: pd.Series) -> pd.Series:
    """The sum of both ratios of a pair, 0 for two spellings that both stand on their own."""
    out = [0.0 if la != lb and sa and sb else lcs_ratio(la, lb) + lcs_ratio(fa, fb) for fa, la, sa, fb, lb, sb in zip(first_a, last_a, sure_a, first_b, last_b, sure_b)]
    return pd.Series(out, dtype="float64")


def slip_keys(word: str) -> list[int]:
    """Hashes of the word and of the word less any one letter, in linear time; words one slip apart share one at least.

    A letter missing or added: the shorter word is the longer one less a letter. A wrong letter, or two neighbours
    swapped: less one letter each, the words are equal.
    """
    powers, ends = [1], [0]  # hashes of the ends of the word, the shortest first
    for c in reversed(word):
        ends.append((ord(c) * powers[-1] + ends[-1]) % _PRIME)
        powers.append(powers[-1] * _BASE % _PRIME)
    out, start, n = {ends[-1]}, 0, len(word)
    for i, c in enumerate(word):
        out.add((start * powers[n - 1 - i] + ends[n - 1 - i]) % _PRIME)
        start = (start * _BASE + ord(c)) % _PRIME
    return list(out)


def _hash(word: str) -> int:
    out = 0
    for c in word:
        out = (out * _BASE + ord(c)) % _PRIME
    return out


def _mixed(*parts: int) -> int:
    out = 7
    for p in parts:
        out = (out * 6_364_136_223_846_793_005 + p) % _PRIME
    return out


def _slips(word: str) -> list[int]:
    return slip_keys(word) if len(word) <= MOST_LETTERS else [_hash(word)]


def index_keys(kind: str, first: str, last: str) -> set[int]:
    """The suffix of one word, refined by the other word and that word less each letter."""
    if kind != "person":
        return {_mixed(0, _hash(first), s) for s in _slips(last)}
    givens, tail = _forms(first), _hash(last[-LEAST_SUFFIX:])
    by_given = {_mixed(1, _hash(g[-LEAST_SUFFIX:]), s) for g in givens for s in _slips(last)}
    return by_given | {_mixed(2, tail, s) for g in givens for s in _slips(g)}


def fine_keys(kind: str, first: str, last: str) -> set[int]:
    """Both words, whole and less each letter: whatever ``index_keys`` brings together and ``same_name`` accepts shares one."""
    if kind != "person":
        return index_keys(kind, first, last)
    return {_mixed(3, a, b) for g in _forms(first) for a in _slips(g) for b in _slips(last)}


_NAMED = "key bigint, id bigint, kind string, first string, last string"


def _keyed(keys):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, out = [], []
            for i, name in enumerate(zip(*(batch.column(c).to_pylist() for c in ("kind", "first", "last")))):
                found = keys(*name)
                at += [i] * len(found)
                out += found
            rows = batch.select(["id", "kind", "first", "last"]).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64()), *rows.columns], ["key", *rows.schema.names])

    return run


def _pairs(block: int | None):
    """Pairs of a key's identities, of rows in the order of their keys; a key of more than ``block`` gives its identities alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, over = None, [], False
        for batch in batches:
            a: list[int] = []
            b: list[int | None] = []
            for k, *who in zip(*(c.to_pylist() for c in batch.columns)):
                if k != key:
                    key, held, over = k, [], False
                if not over and block is not None and len(held) >= block:
                    a += [x[0] for x in held]
                    b += [None] * len(held)
                    over, held = True, []
                if over:
                    a.append(who[0])
                    b.append(None)
                    continue
                id_, kind, first, last = who
                for other, kind_b, first_b, last_b in held:
                    if kind == kind_b and same_name(kind, first, last, first_b, last_b):
                        a.append(min(id_, other))
                        b.append(max(id_, other))
                held.append(who)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def name_pairs(names: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b) of all identities (id, kind, first, last) that share a refined suffix and may be spellings of one name."""
    names = names.select("id", "kind", "first", "last")
    found = lambda df, keys, most: df.mapInArrow(_keyed(keys), _NAMED).repartition("key").sortWithinPartitions("key").mapInArrow(_pairs(most), "a bigint, b bigint").distinct()
    first = cut(found(names, index_keys, block))
    pairs = first.filter("b is not null")
    over = first.filter("b is null").select(F.col("a").alias("id"))
    if not over.take(1):
        return pairs
    fine = cut(found(names.join(over, "id", "left_semi"), fine_keys, None))
    return pairs.unionByName(fine).distinct()


def spelling_links(scored: DataFrame) -> DataFrame:
    """(a, b): the links between spellings, from scored pairs (a, b, score, and of each side _supported, _own and __n).

    Every spelling that is not sure joins its best candidate, so it leads to one sure spelling at most. Groups that
    lead to none are one through all their pairs, and together join their best candidate outside, so that no two
    sure spellings are bridged.
    """
    half = lambda x, y: scored.select(F.col(x).alias("of"), F.col(y).alias("to"), "score", F.col(f"{y}_supported").alias("sure"), F.col(f"{y}__n").alias("n"), F.col(f"{x}_own").alias("own"))
    ranked = half("a", "b").unionByName(half("b", "a")).filter("not own")
    best = cut(ranked.groupBy("of").agg(F.max_by(F.struct("to", "sure"), F.struct("sure", "score", "n", -F.col("to"))).alias("m")).select(F.col("of").alias("a"), F.col("m.to").alias("b"), F.col("m.sure").alias("sure")))
    alike = best.select("a", "b")
    group = connected_components(alike.select(F.explode(F.array("a", "b")).alias("node")), alike)
    led = group.join(best.filter("sure").select(F.col("a").alias("node")), "node", "left_semi").select("component").distinct()
    free = cut(group.join(led, "component", "left_anti").select(F.col("node").alias("of")))
    around = cut(ranked.join(free, "of", "left_semi").join(free.select(F.col("of").alias("to"), F.lit(True).alias("inside")), "to", "left"))
    among = around.filter("inside").select(F.col("of").alias("a"), F.col("to").alias("b"))
    whole = connected_components(free.select(F.col("of").alias("node")), among)
    out = around.filter("inside is null").join(whole, F.col("of") == F.col("node"))
    joins = out.groupBy("component").agg(F.max_by(F.struct(F.col("of").alias("a"), F.col("to").alias("b")), F.struct("score", "n", -F.col("to"), -F.col("of"))).alias("m")).select("m.*")
    return alike.unionByName(among).unionByName(joins)


def link_senders(df: DataFrame, key: str = "sender_id", block: int = BLOCK) -> DataFrame:
    """(key, entity) of every row; rows of one entity share its id. ``key`` must be a unique BIGINT."""
    rows = df.filter(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("_key"), "from_raw", "from_name", "from_email").mapInArrow(_identities, "_key bigint, email string, kind string, first string, last string, supported boolean")
    rows = cut(rows)
    # Addresses several people use: some name on them cannot be their most frequent one.
    on = rows.filter("email is not null and kind in ('person', 'initial', 'org')").groupBy("email", "kind", "first", "last").agg(F.count("*").alias("_n"))
    main = on.groupBy("email").agg(F.max_by(F.struct("kind", "first", "last"), F.struct(F.when(F.col("kind") == "initial", 0).otherwise(1), F.col("_n"), F.col("last"))).alias("m"))
    clash = on.join(main, "email").filter(~_fits("kind", "first", "last", F.col("m.kind"), F.col("m.first"), F.col("m.last"))).select("email").distinct()
    shared = cut(clash.withColumn("_shared", F.lit(True)))
    rows = cut(rows.join(broadcast_if_small(shared), "email", "left").withColumn("_shared", F.coalesce("_shared", F.lit(False))))
    # Identities and the rows' ties to them and to addresses. A spelling is sure if an address holds it or if it
    # comes from two sources, but beside one that comes from MANY times its sources only an address makes it so.
    # A short form of several names stands for one of them and never on its own.
    names = rows.filter("kind in ('person', 'org') and last <> ''").groupBy("kind", "first", "last").agg(F.max("supported").alias("held"), F.count_distinct(F.coalesce("email", F.lit(""))).alias("sources"), F.count("*").alias("_n"), F.min("_key").alias("id"))
    several = (F.col("kind") == "person") & F.col("first").isin(list(AMBIGUOUS))
    names = cut(names.withColumn("held", F.col("held") & ~several).withColumn("supported", F.col("held") | ((F.col("sources") > 1) & ~several)))
    pairs = name_pairs(names, block)
    side = lambda s: names.select(F.col("id").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("first", "last", "supported", "held", "sources", "_n")])
    beside = lambda s, o: F.col(f"{s}_held") | (F.col(f"{s}_supported") & (F.col(f"{s}_sources") * MANY > F.col(f"{o}_sources")))
    both = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("a_own", beside("a", "b")).withColumn("b_own", beside("b", "a"))
    scored = both.withColumn("score", _score("a_first", "a_last", "a_own", "b_first", "b_last", "b_own")).filter("score > 0")
    scored = cut(scored)
    alike = spelling_links(scored)
    ids = names.select("kind", "first", "last", "id")
    tied = rows.join(ids, ["kind", "first", "last"], "left")
    by_name = tied.filter("id is not null").select(F.col("_key").alias("a"), F.col("id").alias("b"))
    own = rows.filter("email is not null and not _shared")
    by_address = own.join(own.groupBy("email").agg(F.min("_key").alias("b")), "email").select(F.col("_key").alias("a"), "b")
    # An initial on a shared address means the one full name there that it fits.
    full = tied.filter("_shared and kind = 'person'").groupBy("email", F.substring("first", 1, 1).alias("first"), "last").agg(F.min("id").alias("b"), F.max("id").alias("_other")).filter("b = _other").drop("_other")
    by_initial = rows.filter("_shared and kind = 'initial'").join(full, ["email", "first", "last"]).select(F.col("_key").alias("a"), "b")
    edges = alike.unionByName(by_name).unionByName(by_address).unionByName(by_initial)
    return connected_components(rows.select(F.col("_key").alias("node")), edges).select(F.col("node").alias(key), F.col("component").alias("entity"))


def entity_pairs(df: DataFrame, key: str = "sender_id") -> DataFrame:
    """(sender_a, sender_b): all pairs of rows of one entity."""
    linked = cut(link_senders(df, key))
    return linked.alias("x").join(linked.alias("y"), (F.col("x.entity") == F.col("y.entity")) & (F.col(f"x.{key}") < F.col(f"y.{key}"))).select(F.col(f"x.{key}").alias("sender_a"), F.col(f"y.{key}").alias("sender_b"))
