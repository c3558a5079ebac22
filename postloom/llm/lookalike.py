"""One form for texts that look the same on the screen.

Marks without ink are dropped, white space and line ends take one form each, and forms that differ in nothing one
sees become plain ones: wide and narrow signs, signs that only forbid a line break, roman numerals, upright and
slanted mathematical letters, ligatures (all found through the Unicode names and decompositions), and a few signs
with the ink of another. Then letters are parted from their accents and each token is resolved by script: every
letter stands for a look, each look can be written in one or more scripts (Latin, Cyrillic, Greek, Armenian,
Cherokee), and the sets of all letters of the token are intersected. If one script can write the whole token, its
letters are used (the first in this order, so the choice depends on the look alone); a token no single script can
write takes the first script of each look. Accents are put back last.

Two texts get the same form exactly if they show the same sequence of letters, signs, spaces and line breaks.
Case, accents, punctuation, wording, raised and lowered digits, script, Fraktur and double-struck letters are kept.
Beside the form it is reported how many tokens mix scripts, and how many stand in one script but could be written
whole in another one. Defined results: NULL stays NULL; texts without visible characters become their white
space; repeated rows get equal forms; long texts are processed whole.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.runtime import cut, spread

# Letters with one look, as Latin, Cyrillic, Greek, Armenian, Cherokee; "-" where a script has none.
LOOKS = (
    "AАΑ-Ꭺ BВΒ-Ᏼ CСϹ-Ꮯ D---Ꭰ EЕΕ-Ꭼ F-Ϝ-- GԌ--Ꮐ HНΗ-Ꮋ IІΙ-- JЈͿ-Ꭻ KКΚ-Ꮶ L---Ꮮ MМΜ-Ꮇ N-Ν-- OОΟՕ- PРΡ-Ꮲ QԚ--- R---Ꭱ SЅ-ՏᏕ TТΤ-Ꭲ U--Ս- VѴ--Ꮩ WԜ--Ꮃ XХΧ-- YҮΥ-Ꮍ Z-Ζ-Ꮓ "
    "aа--- cсϲ-- dԁ--- eе--- g--ց- hһ-հ- iі--- jјϳ-- lӏ--- n--ո- oоοօ- pрρ-- qԛ--- sѕ--- u--ս- vѵν-- wԝ--- xх--- yу--- "
    "-кκ-- -ГΓ-- -ПΠ-- -ФΦ-- ÆӔ--- æӕ--- ƏӘ--- əә--- ƐԐ--- ɛԑε-- ƟӨ--- ɵө--- Þ-Ϸ-- þ-ϸ-- ɑ-α-- ɩ-ι-- ɔ-ͻ--"
).split()
# Further letters of a script with the look of one above.
ALIASES = {"Ӏ": "І", "Ꮢ": "Ꭱ", "Ꮪ": "Ꮥ", "Ꮤ": "Ꮃ", "Ꭹ": "Ꮍ"}
# Signs with the ink of another sign.
SIGNS = {"\u2010": "-", "\u02bc": "\u2019", "\u055a": "\u2019", "\u02bb": "\u2018", "\u2024": ".", "\u2236": ":", "\u01c3": "!", "\u01c0": "|", "\u00b5": "\u03bc"}
LATIN, CYRILLIC, GREEK, ARMENIAN, CHEROKEE, OTHER = range(6)
_SCRIPTS = range(5)
_PREFIXES = (("LATIN ", LATIN), ("CYRILLIC ", CYRILLIC), ("GREEK ", GREEK), ("ARMENIAN ", ARMENIAN), ("CHEROKEE ", CHEROKEE))
_DRAWN = re.compile(r"SCRIPT|FRAKTUR|DOUBLE-STRUCK|BLACK-LETTER")


def _plain_form(c: str) -> str | None:
    """What a character shows if its decomposition is one that leaves the ink as it is."""
    how = unicodedata.decomposition(c)
    if not how.startswith("<"):
        return None
    tag, *points = how.split()
    name = unicodedata.name(c, "")
    same = tag in ("<wide>", "<narrow>", "<noBreak>") or (tag == "<font>" and name.startswith(("MATHEMATICAL ", "PLANCK")) and not _DRAWN.search(name))
    same = same or (tag == "<compat>" and ("ROMAN NUMERAL" in name or "LATIN SMALL LIGATURE" in name))
    return unicodedata.normalize("NFKC", c) if same and tag == "<compat>" else "".join(chr(int(x, 16)) for x in points) if same else None


@lru_cache(1)
def _tables() -> tuple[dict[int, str | None], dict[str, str]]:
    """What goes before decomposition, and the look of each letter."""
    plain: dict[int, str | None] = {}
    # Ideographs and Hangul syllables, which stay as they are, are passed over.
    for i in chain(range(0x3400), range(0xA000, 0xAC00), range(0xD7B0, 0x20000), range(0xE0000, 0xE0200)):
        c = chr(i)
        kind = unicodedata.category(c)
        if kind == "Cf" and not 0x600 <= i <= 0x6DD and i not in (0x70F, 0x8E2, 0x110BD, 0x110CD):
            plain[i] = None
        elif kind == "Cc":
            plain[i] = "\n" if c in "\n\r\x0b\x0c\x85" else " " if c == "\t" else None
        elif kind == "Zs":
            plain[i] = " "
        elif kind in ("Zl", "Zp"):
            plain[i] = "\n"
        elif 0xFE00 <= i <= 0xFE0F or 0xE0100 <= i <= 0xE01EF or i in (0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0):
            plain[i] = None
        elif (shown := _plain_form(c)) is not None:
            plain[i] = "".join(SIGNS.get(x, x) for x in shown)
        elif c in SIGNS:
            plain[i] = SIGNS[c]
    looks = {c: look for look in LOOKS for c in look if c != "-"}
    return plain, looks | {c: looks[of] for c, of in ALIASES.items() if of in looks}


_TOKEN = re.compile(r"[^\W\d_](?:[^\W\d_]|[̀-ͯ])*")
_VISIBLE = re.compile(r"\S")


@lru_cache(100_000)
def _script_of(c: str) -> int:
    name = unicodedata.name(c, "")
    return next((s for prefix, s in _PREFIXES if name.startswith(prefix)), OTHER)


@lru_cache(200_000)
def resolve_token(token: str) -> tuple[str, bool, bool]:
    """Of a decomposed token: its spelling in the one script that can write it, else look by look; whether it mixes scripts; whether it stands whole in a script but the first that could write it."""
    looks = _tables()[1]
    possible, own = set(_SCRIPTS), set()
    for c in token:
        if unicodedata.combining(c):
            continue
        own.add(_script_of(c))
        if c in looks:
            possible &= {s for s in _SCRIPTS if looks[c][s] != "-"}
        else:
            possible &= {_script_of(c)}
    if possible:
        best = min(possible)
        written = "".join(looks[c][best] if c in looks else c for c in token)
    else:
        written = "".join(next(x for x in looks[c] if x != "-") if c in looks else c for c in token)
    return written, len(own) > 1, len(own) == 1 and bool(possible) and own != {min(possible)} and len(possible) > 1


_BEYOND_LATIN = re.compile("[\u0181-\U0010ffff]")


def one_form_reported(text: str | None) -> tuple[str | None, int, int]:
    """The form of a text that depends on its look alone, and its tokens of mixed script and those another script could write."""
    if text is None:
        return None, 0, 0
    text = text.replace("\r\n", "\n")
    if text.isascii():
        return (text if text.isprintable() else text.translate(_tables()[0])), 0, 0
    text = unicodedata.normalize("NFD", text.translate(_tables()[0]))
    counts = [0, 0]

    def put(m: re.Match) -> str:
        token = m.group()
        if token.isascii() or not _BEYOND_LATIN.search(token):
            return token
        written, mixed, whole = resolve_token(token)
        counts[0] += mixed
        counts[1] += whole
        return written

    if _BEYOND_LATIN.search(text):
        text = _TOKEN.sub(put, text)
    return unicodedata.normalize("NFC", text), *counts


def one_form(text: str | None) -> str | None:
    return one_form_reported(text)[0]


def _forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [one_form_reported(t) for t in batch.column(1).to_pylist()]
        visible = [bool(f and _VISIBLE.search(f)) for f, *_ in found]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[0] for x in found], pa.string()), pa.array(visible, pa.bool_()), *(pa.array([x[i] for x in found], pa.int64()) for i in (1, 2))], ["_key", "form", "visible", "n_mixed", "n_whole"])


def normalise_texts(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, form, visible, n_mixed, n_whole) of every row; one narrow pass, no shuffle.

    n_mixed counts tokens whose letters come from several scripts, n_whole tokens of one script that a script
    before it in the order could write whole.
    """
    kind = df.schema[key].dataType.simpleString()
    return spread(df.select(F.col(key), F.col(text))).mapInArrow(_forms, f"_key {kind}, form string, visible boolean, n_mixed bigint, n_whole bigint").withColumnRenamed("_key", key)


def lookalike_pairs(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_a, doc_b): all pairs of rows with equal forms and unequal texts.

    Only 32-byte digests of forms and texts are shuffled. Spellings that share a form are paired first (one row
    for each spelling, not for each copy); rows join their spelling afterwards, so copies of one string cost nothing.
    """
    kind = df.schema[key].dataType.simpleString()
    named = df.filter(F.col(text).isNotNull() & F.col(key).isNotNull()).select(F.struct(F.col(key).alias("k"), F.sha2(F.col(text), 256).alias("t")).alias("_k"), F.col(text))
    forms = normalise_texts(named, "_k", text).filter("visible").select(F.col("_k.k").cast(kind).alias("doc"), F.col("_k.t").alias("spelling"), F.sha2("form", 256).alias("form"))
    forms = cut(forms)
    spellings = forms.groupBy("form", "spelling").agg(F.count("*").alias("_n"))
    several = spellings.groupBy("form").agg(F.count("*").alias("_s")).filter("_s > 1").select("form")
    spellings = spellings.join(several, "form", "left_semi").select("form", "spelling")
    pairs = spellings.alias("a").join(spellings.alias("b"), (F.col("a.form") == F.col("b.form")) & (F.col("a.spelling") < F.col("b.spelling"))).select(F.col("a.spelling").alias("left_s"), F.col("b.spelling").alias("right_s"))
    one = forms.select(F.col("spelling").alias("left_s"), F.col("doc").alias("_left"))
    two = forms.select(F.col("spelling").alias("right_s"), F.col("doc").alias("_right"))
    full = pairs.join(one, "left_s").join(two, "right_s")
    return full.select(F.least("_left", "_right").alias("doc_a"), F.greatest("_left", "_right").alias("doc_b"))
