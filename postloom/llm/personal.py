"""Finds personal items in free text and replaces them by typed placeholders.

A skip-chain conditional random field over the candidate tokens of a document. Candidates are e-mail addresses
(plain and spelt out), number groups, street and box addresses, and all runs of capitalised words or initials of
any script that has capitals, particles included; in small letters, words around a given name, an initial or a
word that the document writes as a name or an address elsewhere. A token's features are its own class (whether a
list holds it is one of them), the classes of its neighbours in the run and the words around it. Neighbours in a
run share chain potentials; tokens that recur anywhere in the document, the same or nearly the same, share skip
potentials, so that what is clear at one place settles the doubtful mention at another. Messages are passed round
the loops of a document until none changes by more than SETTLED; each token takes its most probable label. A name
that no list and no initial supports must be likely to SURE.

The weights are fitted once per process by pseudo-likelihood on sentences with known labels that
``personal_training`` writes (TRAINING_TEXTS of them, a fixed bound); nothing of the corpus is needed.

Defined results: NULL and empty texts have no items; positions count code points from 1; an item starts at the
bracket, plus sign or house, flat or box designation that opens it. Very long texts are searched whole: candidates
are found in time linear in the length, and messages travel one mention a round. Damping makes them settle in some
tens of rounds; MOST_ROUNDS ends what would swing for ever. Names in scripts without capitals are not found.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm.entities import lcs_ratio
from postloom.llm.names import AMBIGUOUS, GIVEN, NICKNAMES, ORG_SHORT, ORG_WORDS, TITLES
from postloom.runtime import spread

TRAINING_TEXTS = 4000
#: Messages are settled when none changes by more than this.
SETTLED = 1e-3
MOST_ROUNDS = 2000
DAMPING = 0.3
#: Least probability of a name without a listed given name or an initial.
SURE = 0.9


def _letters(*kinds: str) -> str:
    """A character class of all letters of the given Unicode categories."""
    out, start = [], None
    for i in chain(range(0x3401), range(0xA000, 0xAC01), range(0xF900, 0x20001)):  # between these no letter has a case
        inside = unicodedata.category(chr(i)) in kinds
        if inside and start is None:
            start = i
        if not inside and start is not None:
            out.append(f"\\U{start:08x}-\\U{i - 1:08x}")
            start = None
    return "".join(out)


_UP, _LOW = _letters("Lu", "Lt"), _letters("Ll")
#: White space inside a name; a line end may be followed by quote prefixes.
_GAP = r"(?:[ \t]{1,3}|[ \t]{0,3}\n[ \t]*(?:(?:[A-Za-z]{0,4}>|[|:}])[ \t]*)*)"
_IN = r"[\w'’\u0300-\u036f-]"
_CAP = rf"[{_UP}](?:{_IN}*[\w\u0300-\u036f])?\.?"
# Small words inside names.
PARTICLES = "van von der den de la las los del della di da dos du le ter ten zu bin ibn al el".split()
_PART = rf"(?:{'|'.join(PARTICLES)})(?={_GAP})"
_RUN = re.compile(rf"(?<![\w@./+-]){_CAP}(?:,?{_GAP}(?:{_PART}{_GAP}){{0,3}}{_CAP})+(?![\w@]|\.\w)")
_SPLIT = re.compile(rf"({_CAP}|{_PART})(,?)({_GAP})?")
_LOWER_SPLIT = re.compile(rf"([{_LOW}]{_IN}*\.?)(,?)({_GAP})?")
_PUNCTUATION = " .,;:!?\"'’()[]{}<>|*_-"
# Names that in small letters are mostly other words open a candidate only if the document knows them as names.
_LOWER_NAMES = (GIVEN | set(NICKNAMES) | set(AMBIGUOUS)) - set("will rich bill pat sue sandy jack rob nick kit ray rose mark art ant dick gail kay meg nell bob ron theo tori drew al may june dan ben ed ken jen deb sally polly molly nat sam ted tim tom liz joe jon".split()) | {"jon"}
_LOWER_NEXT = re.compile(rf"{_GAP}([{_LOW}]\.{_GAP})?[{_LOW}]{_IN}+(?![\w@]|\.\w)")
_LOWER_LAST = re.compile(rf"(?<![\w@./+-])[{_LOW}]{_IN}+,{_GAP}$")
_LOWER_INITIAL = re.compile(rf"(?<![\w@./+-])[{_LOW}]\.{_GAP}(?=([{_LOW}]{_IN}+))")
_DOT = r"(?:\.|\s?\[dot\]\s?|\s?\(dot\)\s?|[ ]dot[ ])"
# What follows the local part of a plain address, and an address that is spelt out.
_HOST = re.compile(rf"@[\w-]+(?:{_DOT}[\w-]+)*{_DOT}[A-Za-z]{{2,}}\b", re.I)
_SPELT = re.compile(rf"(?<![\w.+-])[\w][\w.+-]*(?:[ ]?\[at\][ ]?|[ ]?\(at\)[ ]?|[ ]at[ ](?=[\w-]+(?:[ ]dot[ ])))[\w-]+(?:{_DOT}[\w-]+)*{_DOT}[A-Za-z]{{2,}}\b", re.I)
_NUMBER = re.compile(
    r"(?<![\w./@#$-])(?:"
    r"\+44 \d{4} \d{6}|\+1[ .-]\d{3}[ .-]\d{3}[ .-]\d{4}"
    r"|\+\d{1,3}(?:[ .-]?\(\d{1,5}\))?[ .-]?\d{2,5}(?:[ .-]?\d{3,6}){1,3}"
    r"|1[-. ]\d{3}[-. ]\d{3}[-. ]\d{4}"
    r"|\(\d{3,5}\)[ ]?\d{3}[-. ]\d{3,4}"
    r"|\d{3}[-. ]\d{3}[-. ]\d{4}"
    r"|0\d{2,4} \d{3,4} \d{3,4}"
    r"|\d{6}-\d{4}|\d{3}([-. ])\d{2}\1\d{4}|\d{3}-\d{4}|\d{9,10}"
    r"|[A-Z]\d{3}-\d{4}-\d{4}|[A-Z] ?\d{7}"
    r"|\+\d{1,3}(?:[ .-]\(?\d{1,4}\)?){3,6}|\+\d{8,15}|0\d(?:[ .-]\d{2}){4}|0\d{1,5} ?/ ?\d{3,8}(?:[ -]\d{2,6}){0,3}|\(0\d{1,5}\) ?\d{3,8}(?:[ -]\d{2,6}){0,3}|0\d{1,4}-\d{2,4}-\d{3,4}|0\d{2,4}[ -]\d{5,8}"
    r")(?:[ ]?(?:x|ext\.?)[ ]?\d{1,5})?(?![\w@]|[-./]\w)"
)
_STREET = r"(?:Street|St|Road|Rd|Lane|Ln|Avenue|Ave|Close|Court|Ct|Terrace|Row|Yard|Drive|Place|Square|Sq|Crescent|Boulevard|Blvd|Way|Walk|Hill|Gardens|Mews)\b\.?"
_TOWN = rf"(?:,[ \t]*(?:Apt|Flat|Unit|Suite)\.? \d+)?(?:,?{_GAP}(?:\d{{5}} )?[A-Z][a-z]+(?:-[A-Z][a-z]+)*(?: \d{{5}}\b)?|(?={_GAP}))?"
_ADDRESS = re.compile(rf"(?<![\w./-])(?:(?:(?:Flat|Apt|Unit|Suite)\.? \d+[a-z]?, )?\d{{1,5}}[a-z]? (?:[A-Z][\w'-]+ ){{1,2}}{_STREET}|P\.?[ ]?O\.? ?Box \d+|[A-Z][a-zäöüß]+(?:weg|straße|strasse|gasse|allee|platz|ring|damm) \d+[a-z]?)({_TOWN})")
_ACCOUNT = re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
_URL = re.compile(r"(?i)\b(?:https?|ftp|gopher|mailto|news)://\S+")
_AFTER = re.compile(r"[\s>|:}]*([<(@]|[^\W\d_][\w-]*|/)?")
_MARKS = re.compile(r"\n[ \t]*(?:(?:[A-Za-z]{0,4}>|[|:}])[ \t]*)*$")
_ID_SHAPES = (re.compile(r"\d{3}([-. ])\d{2}\1\d{4}$|\d{9}$"), re.compile(r"\d{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])-\d{4}$"), re.compile(r"[A-Z]\d{3}-\d{4}-\d{4}$"), re.compile(r"[A-Z] ?\d{7}$"))

_HEX, _HEX_AFTER = re.compile(r"[0-9A-F]{8}"), re.compile(r"[\s>|:}]+[0-9A-F]{8}\b")

# Words that open sentences or close letters and are no part of a name.
STOP = frozenset(
    """a an and as ask at are be been but by call can contact did do does each fax folks for from give greetings has have
    he hello hi his how i if in is it its let mail me mr my next no nobody not now of on once one or our part passport please
    post questions quote reach ring run saw see send she so somebody someone subject thanks that the their then there they
    this to tuesday monday wednesday thursday friday saturday sunday january february march april june july august september
    october november december version was we what when where which while who why will with without write yes yet you your
    dear sent date newsgroups anyone bounces another copy quoting according am born taxpayer travel voice tel phone""".split()
)
CLOSING = frozenset("best regards cheers yours sincerely thanks ciao greetings love faithfully truly bye".split())
# Words of occupations, words of speech, and words around items.
JOBS = frozenset("consultant engineer clerk manager professor editor director student secretary assistant researcher officer programmer analyst operator administrator fellow senior junior chief staff research network systems software project".split())
SAID = frozenset("wrote writes said says spake schrieb schreibt writes: disagrees disagreed gave put has had asked thinks here reads on at id phone wants thought spoke pointed explains replied told".split())
CUES = frozenset("called contact reach ask name was named according cc dear quoting mr mrs ms dr prof professor signed met author bcc attn contacting schrieb".split())
HEADS = frozenset("from to cc bcc author contact name attn dear sender by".split())
WEAK_CUES = frozenset("to with by from as of and".split())
SMALL_WORDS = frozenset("the a an this that these every no our your its his her their in until once than say says said on for at about week if when while".split())
PHONE_CUES = frozenset("tel telephone phone voice fax call ring dial dial-in reach pager beeper mobile cell handy on at is me try number still answers or to".split())
ID_CUES = frozenset("ssn social security number taxpayer passport document travel national id identity licence license sec no born typed wrote as reads keyed entered noted is in".split())
ID_WORDS = frozenset("ssn social security taxpayer passport national id identity licence license document".split())
GOODS_WORDS = frozenset("part invoice order serial item model bytes version".split())
OTHER_CUES = frozenset("part invoice ping version take order serial bytes port key fingerprint item model lines and".split())
MESSAGE_CUES = frozenset("message article to id message-id references answers".split())

WORD, MAIL, NUMBER, PLACE = range(4)
#: Each node has three labels: none, then by type begin/inside of a name, address, phone/identity number, place.
KINDS = {(WORD, 1): "name", (MAIL, 1): "email", (NUMBER, 1): "phone", (NUMBER, 2): "id_number", (PLACE, 1): "address"}
CHAIN, COMMA, SAME, NEAR = range(4)


class Graph:
    """The candidate tokens of a batch of documents with their features and edges."""

    def __init__(self) -> None:
        self.doc: list[int] = []
        self.span: list[tuple[int, int]] = []
        self.kind: list[int] = []
        self.joined: list[int] = []  # -1, or the token before it in its run
        self.features: list[int] = []
        self.offsets: list[int] = []
        self.edges: list[tuple[int, int, int]] = []
        self.names: list[str] = []


_PARTICLES = frozenset(PARTICLES)


def _class_of(word: str) -> str:
    bare = word.rstrip(".").lower()
    if len(bare) == 1:
        return "I"
    if bare in GIVEN or bare in NICKNAMES or bare in AMBIGUOUS:
        return "G"
    if word in _PARTICLES:
        return "P"
    if sum(map(str.isdigit, bare)) > 1:
        return "D"
    if bare in CLOSING:
        return "K"
    if bare in STOP or bare in TITLES:
        return "S"
    if bare in ORG_WORDS or bare in ORG_SHORT:
        return "O"
    if bare in JOBS:
        return "J"
    return "w" if word[0].islower() else "T"


class Features:
    """Feature names to columns; frozen after training."""

    def __init__(self) -> None:
        self.at: dict[str, int] = {}
        self.seen: dict[tuple, list[int]] = {}  # the columns of a token by what its features are made of
        self.frozen = False

    def add(self, out: list[int], name: str) -> None:
        i = self.at.get(name)
        if i is None:
            if self.frozen:
                return
            i = self.at[name] = len(self.at)
        out.append(i)


def _line_break(text: str, at: int) -> int | None:
    """Where the line before ends if only white space and quote marks stand between a line's beginning and a position; -1 at the beginning of the text."""
    while at:
        c = text[at - 1]
        if c in " \t|:}":
            at -= 1
        elif c == ">":
            at -= 1
            most = max(0, at - 4)
            while at > most and text[at - 1].isascii() and text[at - 1].isalpha():
                at -= 1
        else:
            return at - 1 if c == "\n" else None
    return -1


def _cue(text: str, start: int) -> tuple[str, str, str]:
    """Where a position stands ("n": first on its line, else "s"), the word before it, on its line or at the end of the line before, and a colon if one parts them."""
    while start and text[start - 1] in "<([\"'":
        start -= 1
    broken = _line_break(text, start)
    low = start if broken is None else max(broken, 0)
    while low and text[low - 1].isspace() and (broken is not None or text[low - 1] != "\n"):
        low -= 1
    at = low
    while at and (c := text[at - 1]) != "\n" and not c.isalnum() and c != "_":
        at -= 1
    end = at
    while at and ((c := text[at - 1]).isalnum() or c in "_.'-"):
        at -= 1
    word = text[at:end].lstrip("0123456789_.'-").lower()
    return "s" if broken is None else "n", word, ":" if word and ":" in text[end:low] else ""


def _words_before(text: str, start: int, n: int = 3) -> list[str]:
    """The n words before a position, the nearest first, quote marks aside."""
    out, at = [], start
    for _ in range(n):
        while at and not text[at - 1].isalnum():
            if text[at - 1] == ">" or text[at - 1] == "\n":
                broken = _line_break(text, at)
                at = max(broken, 0) if broken is not None else at - 1
            else:
                at -= 1
        end = at
        while at and (text[at - 1].isalnum() or text[at - 1] in "-'"):
            at -= 1
        out.append(text[at:end])
    return out


def _after(text: str, end: int) -> str:
    m = _AFTER.match(text, end)
    return (m.group(1) or "").lower() if m else ""


def _covers(spans: list[tuple[int, int]]):
    """Whether a position lies in one of the spans; a look-up by bisection."""
    spans = sorted(spans)
    starts, ends = [a for a, _ in spans], list(accumulate((b for _, b in spans), max))
    return lambda i: (k := bisect_right(starts, i)) > 0 and ends[k - 1] > i


def _local_words(mails: list[str]) -> set[str]:
    """Words that local parts of addresses hold: their pieces, also without up to three letters at either end."""
    out = set()
    for mail in mails:
        for piece in re.split(r"[._+\d-]+", re.split(r"@| at |\[at\]|\(at\)", mail)[0].strip()):
            out.update(x for n in range(4) for x in (piece[n:], piece[: len(piece) - n]) if len(x) > 3)
    return out


def _node(g: Graph, doc: int, start: int, end: int, kind: int, joined: int, name: str) -> int:
    g.doc.append(doc)
    g.span.append((start, end))
    g.kind.append(kind)
    g.joined.append(joined)
    g.names.append(name)
    g.offsets.append(len(g.features))
    return len(g.doc) - 1


def _add_run(g: Graph, feats: Features, doc: int, text: str, start: int, run: str, locals_: set[str]) -> None:
    small = run[0].islower()
    parts = [(m.group(1), m.group(2), m.group(3) or "", start + m.start(1)) for m in (_LOWER_SPLIT if small else _SPLIT).finditer(run)]
    parts = [(w[:-1] if w.endswith(".") and len(w) > 2 and w[:-1].lower() not in TITLES else w, w.endswith(".") and len(w) > 2, comma, gap, at) for w, comma, gap, at in parts]
    line, before, colon = _cue(text, parts[0][4])
    begin = 0
    for end in range(1, len(parts) + 1):
        w, stop, comma, gap, _ = parts[end - 1]
        if end < len(parts) and not stop and not (comma and "\n" in gap and _class_of(w) == "K"):
            continue
        _add_segment(g, feats, doc, text, parts[begin:end], line, before, colon, locals_)
        line, before, colon, begin = "n" if "\n" in gap else "s", w.lower().rstrip("."), "", end


def _token_features(feats: Features, cls, lc, left, rc, right, two, back, i, cue, bare, supported, follows, n, whole, org, final, local, upper, foreign) -> list[int]:
    names = [f"c{cls}", f"l{left}{lc}{cls}", f"r{cls}{right}{rc}", f"b{lc}{left}{cls}{right}{rc}", f"ctx{supported}{cue}{follows}{n}", f"first{supported}{cue}{i}", f"whole{supported}{whole}{i}", f"org{supported}{org}"]
    if two:
        names.append(f"q{two}")
    if back:
        names.append(f"p{back}")
    if i == 0:
        names += [f"cue{cue}{cls}", *([f"linestart{cls}"] if bare else [])]
    if final:
        names += [f"next{final}{cls}", f"nextu{supported}{follows}"]
    names += [name for name, is_so in ((f"local{cls}", local), (f"upper{cls}", upper), (f"foreign{cls}", foreign)) if is_so]
    out: list[int] = []
    for name in names:
        feats.add(out, name)
    return out


def _add_segment(g: Graph, feats: Features, doc: int, text: str, parts: list, line: str, before: str, colon: str, locals_: set[str]) -> None:
    """The part of a run between full stops."""
    classes = [_class_of(w) for w, *_ in parts]
    skip = 0
    while skip < len(parts) and classes[skip] == "S":  # titles and words that open a sentence are what stands before
        line, before, colon = "s", parts[skip][0].lower().rstrip("."), ""
        skip += 1
    parts, classes = parts[skip:], classes[skip:]
    n = len(parts)
    if n < 2:
        return
    links = ["," if comma else "n" if "\n" in gap else "_" for _, _, comma, gap, _ in parts[:-1]]  # between token i and i + 1
    supported = "L" if {"G", "I"} & set(classes) else "U"
    cue = ("+" if before in HEADS else "-") if colon else "+" if before in CUES else "w" if before in WEAK_CUES else "d" if before in SMALL_WORDS else "-" if before else "0"
    org = "O" in classes
    last = -1
    end = parts[-1][4] + len(parts[-1][0])
    whole = line == "n" and text[end : end + 1] in ("", "\n", "\r")
    nxt = _after(text, end)
    follows = "<" if nxt in ("<", "(", "@") else "+" if nxt in SAID or nxt == "/" else "v" if nxt.endswith("s") else "e" if not nxt else "-"
    for i, (w, stop, comma, gap, at) in enumerate(parts):
        left = links[i - 1] if i else ""
        right = links[i] if i < n - 1 else ""
        cls, lc, rc = classes[i], classes[i - 1] if left else "", classes[i + 1] if right else ""
        key = w.lower().rstrip(".")
        node = _node(g, doc, at, at + len(w), WORD, last if left else -1, key)
        two = f"{cls}{right}{rc}{links[i + 1]}{classes[i + 2] if links[i + 1] else ''}" if i + 2 < n and right else ""
        back = f"{classes[i - 2] if links[i - 2] else ''}{links[i - 2]}{lc}{left}{cls}" if i >= 2 and left else ""
        final = ("<" if nxt in ("<", "(", "@") else "+" if nxt in SAID or nxt == "/" else "-") if i == n - 1 else ""
        local, upper, foreign = len(key) > 3 and cls in "TGw" and key in locals_, w.isupper() and len(w) > 2, not w.isascii()
        seen = (cls, lc, left, rc, right, two, back, min(i, 3), cue, not before, supported, follows, min(n, 4), whole, org, final, local, upper, foreign)
        found = feats.seen.get(seen)
        if found is None:
            found = _token_features(feats, *seen)
            if feats.frozen:
                feats.seen[seen] = found
        g.features += found
        if left:
            g.edges.append((last, node, COMMA if left == "," else CHAIN))
        last = node


def _digit_shape(text: str) -> str:
    shape = re.sub(r"\d+", lambda m: str(len(m.group())), re.sub(r"[ ]?(?:x|ext\.?)[ ]?\d+$", "x", text))
    return re.sub(r"[A-Z]", "L", shape)


def _addresses(text: str) -> list[tuple[int, int]]:
    """Where e-mail addresses stand, plain and spelt out, in order and without overlaps."""
    out, at = [], text.find("@")
    while at >= 0:
        start = at
        while start and ((c := text[start - 1]).isalnum() or c in "_.+-"):
            start -= 1
        m = _HOST.match(text, at) if start < at and text[start] not in ".+-" else None
        if m and (not out or start >= out[-1][1]):
            out.append((start, m.end()))
        at = text.find("@", m.end() if m else at + 1)
    lower = text.lower()
    if "(at)" in lower or "[at]" in lower or (" at " in lower and " dot " in lower):
        inside = _covers(out)
        out += [m.span() for m in _SPELT.finditer(text) if not inside(m.start())]
        out.sort()
    return out


def add_document(g: Graph, feats: Features, doc: int, text: str) -> None:
    """Candidates, features and edges of one text."""
    first = len(g.doc)
    urls = [m.span() for m in _URL.finditer(text)] if "://" in text else []
    inside = _covers(urls)
    add, taken = feats.add, list(urls)
    mails = [span for span in _addresses(text) if not inside(span[0])]
    locals_ = _local_words([text[a:b].lower() for a, b in mails])
    for start, end in mails:
        _node(g, doc, start, end, MAIL, -1, text[start:end].lower())
        out, cue = g.features, _cue(text, start)[1]
        angle = text[start - 1 : start] == "<"
        add(out, "mail" + ("<" if angle else ""))
        local = text[start:end].split("@")[0]
        add(out, "local" + ("hex" if re.search(r"\d{5}|^m-[0-9A-F]{6}|^[0-9a-f]{6,}[.]|\.AA[0-9A-F]*$", local) else "plain") + ("<" if angle else ""))
        add(out, "mailcue" + ("+" if cue in MESSAGE_CUES else "-") + ("<" if angle else ""))
        add(out, "mailnext" + ("of" if _after(text, end + 1) == "of" else "") + ("<" if angle else ""))
        add(out, "mailcue2" + (cue if cue in MESSAGE_CUES else "") + ("<" if angle else ""))
        taken.append((start, end))
    for m in _ADDRESS.finditer(text):
        start, end = m.span()
        _node(g, doc, start, end, PLACE, -1, m.group().lower())
        add(g.features, "place")
        add(g.features, "place" + ("box" if "ox" in m.group()[:9] else "way" if m.group()[0].isalpha() and not m.group().startswith(("Flat", "Apt", "Unit", "Suite")) else "house"))
        taken.append((start, end))
    numbers = [m for m in _NUMBER.finditer(text)]
    inside = _covers([*taken, *(m.span() for m in _ACCOUNT.finditer(text))]) if numbers else _covers(taken)
    for m in numbers:
        start, end = m.span()
        if inside(start):
            continue
        value = m.group()
        if value[0] == "(" and ")" not in value:
            start, value = start + 1, value[1:]
        known = next((i for i, p in enumerate(_ID_SHAPES) if p.match(value)), -1)
        near = _words_before(text, start)
        if known == 3 and (_HEX.fullmatch(near[0]) or _HEX_AFTER.match(text, end)):
            continue  # one group of a fingerprint
        _node(g, doc, start, end, NUMBER, -1, re.sub(r"\D", "", value))
        out, (line, word, _) = g.features, _cue(text, start)
        add(out, f"shape{_digit_shape(value)}")
        add(out, f"form{value[0] if value[0] in '+(0' else '1'}{sum(map(str.isdigit, value))}")
        add(out, f"id{known}")
        around = {w.lower() for w in near}
        part = "part" in around
        add(out, "idwords" + ("+" if around & ID_WORDS else "-") + str(known))
        add(out, "goods" + ("+" if around & GOODS_WORDS else "-") + str(known))
        neg = word in OTHER_CUES
        add(out, "neg" + ("+" if neg or part else "-") + str(known))
        add(out, "phonecue" + ("+" if word in PHONE_CUES else "-") + str(known))
        add(out, "idcue" + ("+" if word in ID_CUES and not part else "-") + str(known))
        add(out, "word" + (word if word in PHONE_CUES or word in ID_CUES or word in OTHER_CUES else "?"))
        alone = line == "n" and text[end : end + 1] in ("", "\n", " ", "|")
        add(out, f"alone{alone}{known}")
        nxt = _after(text, end)
        add(out, "nextword" + (nxt if nxt in ("bytes", "instead", "is", "was", "when", "rings", "after", "by", "before", "if") else "?"))
    inside = _covers(taken)
    words: set[str] = set()
    for m in _RUN.finditer(text):
        start, run = m.start(), m.group()
        if not inside(start):
            _add_run(g, feats, doc, text, start, run, locals_)
            words.update(w.group(1).lower() for w in _SPLIT.finditer(run))
    known_here = {w for w in words | locals_ if len(w) > 3}
    tokens = {t.strip(_PUNCTUATION) for t in set(text.split())}
    openers = {w for w in tokens if w in _LOWER_NAMES or (w not in STOP and (w in known_here or w in GIVEN or w in NICKNAMES or w in AMBIGUOUS))}
    for at_word, word in sorted((at, w) for w in openers if w[0].islower() for at in _places(text, w)):
        for run, at in _lower_runs(text, at_word, at_word + len(word)):
            if (word in _LOWER_NAMES or _known_pair(run, known_here, word)) and not inside(at):
                _add_run(g, feats, doc, text, at, run, locals_)
    if not locals_.isdisjoint(tokens):
        for m in _LOWER_INITIAL.finditer(text):
            if m.group(1) in known_here and m.group(1) in locals_ and not inside(m.start()):
                _add_run(g, feats, doc, text, m.start(), text[m.start() : m.end(1)], locals_)
    _skip_edges(g, first)


def _places(text: str, word: str) -> Iterator[int]:
    """Where a word stands by itself, not in a path or an address."""
    at = text.find(word)
    while at >= 0:
        end = at + len(word)
        before, after = text[at - 1 : at], text[end : end + 1]
        if not (before and (before.isalnum() or before in "_@./+-")) and not (after and (after.isalnum() or after in "_'’-")):
            yield at
        at = text.find(word, end)


def _known_pair(run: str, known: set[str], word: str) -> bool:
    """Whether the other word of a run in small letters stands in the document as part of a name or an address, and both do unless a list holds one."""
    others = [w for w in (m.group(1).rstrip(".") for m in _LOWER_SPLIT.finditer(run)) if w != word]
    return any(w in known and w not in STOP for w in others)


def _before_gap(text: str, start: int) -> int:
    """Where a word before a comma and a gap that ends at start may begin, start itself without such a comma; looks no further back."""
    at = start
    while at and text[at - 1] in " \t>|:}":
        at -= 1
        if text[at] == ">":
            most = max(0, at - 4)
            while at > most and text[at - 1].isascii() and text[at - 1].isalpha():
                at -= 1
    if at and text[at - 1] == "\n":
        at -= 1
        while at and text[at - 1] in " \t":
            at -= 1
    if not at or text[at - 1] != ",":
        return start
    at -= 1
    while at and (text[at - 1].isalnum() or text[at - 1] in "'’-"):
        at -= 1
    return at


def _lower_runs(text: str, start: int, end: int) -> list[tuple[str, int]]:
    """A given name in small letters with the word behind it, or with the word before its comma."""
    out = []
    m = _LOWER_NEXT.match(text, end)
    if m:
        out.append((text[start : m.end()], start))
    at = _before_gap(text, start)
    m = _LOWER_LAST.search(text, at, start) if at < start else None
    if m:
        out.append((text[m.start() : end], m.start()))
    return out


def _skip_edges(g: Graph, first: int) -> None:
    """Links each mention to the one before it of the same word, and a new word to the nearest similar one."""
    last: dict[tuple[int, str], int] = {}
    by_ends: dict[str, str] = {}
    for i in range(first, len(g.doc)):
        name, kind = g.names[i], g.kind[i]
        if len(name) < 3:
            continue
        known = last.get((kind, name))
        if known is not None:
            if not (kind == WORD and g.joined[i] == known):
                g.edges.append((known, i, SAME))
        elif kind == WORD and len(name) > 5:
            for end in (name[:3], name[-3:]):
                other = by_ends.get(end)
                if other is not None and other != name and abs(len(other) - len(name)) < 3 and lcs_ratio(other, name) >= 0.85:
                    j = last[(WORD, other)]
                    if g.joined[i] != j:
                        g.edges.append((j, i, NEAR))
                    break
            by_ends[name[:3]] = by_ends[name[-3:]] = name
        last[(kind, name)] = i


class Model:
    """Weights of features (features x 3) and of edges (4 x 3 x 3)."""

    def __init__(self, feats: Features, nodes: np.ndarray, pairs: np.ndarray) -> None:
        self.feats, self.nodes, self.pairs = feats, nodes, pairs

    def potentials(self, g: Graph) -> np.ndarray:
        n = len(g.doc)
        out = np.zeros((n, 3))
        if len(g.features):
            owner = np.repeat(np.arange(n), np.diff([*g.offsets, len(g.features)]))
            np.add.at(out, owner, self.nodes[g.features])
        kind = np.array(g.kind)
        out[np.isin(kind, (MAIL, PLACE)), 2] = -1e4
        return out

    def marginals(self, g: Graph) -> np.ndarray:
        """Sum-product messages along all edges, both ways, damped; a document is left alone once its messages have settled."""
        theta = self.potentials(g)
        if g.edges:
            a, b, t = np.array(g.edges).T
            source, target = np.concatenate([a, b]), np.concatenate([b, a])
            pair = np.concatenate([self.pairs[t], self.pairs[t].transpose(0, 2, 1)])
            m = len(a)
            back = np.concatenate([np.arange(m, 2 * m), np.arange(m)])
            doc = np.array(g.doc)[source]
            message = np.zeros((2 * m, 3))
            belief = theta.copy()
            active = np.arange(2 * m)
            for _ in range(MOST_ROUNDS):
                cavity = belief[source[active]] - message[back[active]]
                joint = cavity[:, :, None] + pair[active]
                top = joint.max(1)
                new = top + np.log(np.exp(joint - top[:, None, :]).sum(1))
                new -= new.max(1, keepdims=True)
                new = DAMPING * message[active] + (1 - DAMPING) * new
                change = new - message[active]
                np.add.at(belief, target[active], change)
                message[active] = new
                moving = np.unique(doc[active[np.abs(change).max(1) > SETTLED]])
                if not len(moving):
                    break
                active = active[np.isin(doc[active], moving)]
            theta = theta.copy()
            np.add.at(theta, target, message)
        theta -= theta.max(1, keepdims=True)
        p = np.exp(theta)
        return p / p.sum(1, keepdims=True)

    def items(self, texts: list[str | None]) -> list[list[tuple[int, int, str]]]:
        """For each text its items as (start, end, kind), in order; positions from 0, end exclusive."""
        g = Graph()
        for doc, text in enumerate(texts):
            if text:
                add_document(g, self.feats, doc, text)
        found: list[list[tuple[int, int, str]]] = [[] for _ in texts]
        if not g.doc:
            return found
        chance = self.marginals(g)
        label = chance.argmax(1)
        i, n = 0, len(g.doc)
        while i < n:
            if label[i] == 0:
                i += 1
                continue
            kind, (start, end) = g.kind[i], g.span[i]
            if kind != WORD:
                found[g.doc[i]].append((start, end, KINDS[kind, int(label[i])]))
                i += 1
                continue
            j = i + 1
            while j < n and label[j] == 2 and g.kind[j] == WORD and g.joined[j] == j - 1:
                j += 1
            # The exact check: two words at least, one of them a full one; without a listed given name or an initial all must be sure and none another kind of word.
            classes = [_class_of(x) for x in g.names[i:j]]
            backed = {"G", "I"} & set(classes)
            full = any(c in "TwG" and len(x) > (1 if "G" in classes else 2) for c, x in zip(classes, g.names[i:j]))
            firm = j < n and g.kind[j] == WORD and g.joined[j] == j - 1 and _class_of(g.names[j]) == "O"  # an organisation's word goes on behind it
            if j - i > 1 and full and (backed or (not firm and chance[i:j, 0].max() <= 1 - SURE and not set(classes) & set("SKJOD") and not texts[g.doc[i]][start].islower())):
                found[g.doc[i]].append((start, g.span[j - 1][1], "name"))
            i = j
        return [_apart(x) for x in found]


def _apart(items: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """In order and without overlaps; of two the longer stays."""
    out: list[tuple[int, int, str]] = []
    for item in sorted(items):
        if out and item[0] < out[-1][1]:
            if item[1] - item[0] > out[-1][1] - out[-1][0]:
                out[-1] = item
        else:
            out.append(item)
    return out


def fit(examples: list[tuple[str, list[tuple[int, int, str]]]], epochs: int = 40, rate: float = 0.5, seed: int = 7) -> Model:
    """Pseudo-likelihood: each label given its features and its neighbours' labels, by AdaGrad over all tokens."""
    feats, g, labels = Features(), Graph(), []
    for doc, (text, items) in enumerate(examples):
        before = len(g.doc)
        add_document(g, feats, doc, text)
        begins = {(s, k): e for s, e, k in items}
        for i in range(before, len(g.doc)):
            (s, e), kind = g.span[i], g.kind[i]
            y = 0
            if kind == WORD:
                y = 1 if (s, "name") in begins else 2 if any(k == "name" and a < s and e <= b for a, b, k in items) else 0
            elif kind == MAIL:
                y = int((s, "email") in begins)
            elif kind == PLACE:
                y = int((s, "address") in begins)
            else:
                y = 1 if (s, "phone") in begins else 2 if (s, "id_number") in begins else 0
            labels.append(y)
    feats.frozen = True
    n, y = len(g.doc), np.array(labels)
    owner = np.repeat(np.arange(n), np.diff([*g.offsets, len(g.features)]))
    columns = np.array(g.features)
    a, b, t = np.array(g.edges).T
    nodes, pairs = np.zeros((len(feats.at), 3)), np.zeros((4, 3, 3))
    sum_n, sum_p = np.full_like(nodes, 1e-3), np.full_like(pairs, 1e-3)
    mask = np.zeros((n, 3))
    mask[np.isin(np.array(g.kind), (MAIL, PLACE)), 2] = -1e4
    target = np.eye(3)[y]
    for _ in range(epochs):
        theta = mask.copy()
        np.add.at(theta, owner, nodes[columns])
        np.add.at(theta, b, pairs[t, y[a]])
        np.add.at(theta, a, pairs[t, :, y[b]])
        theta -= theta.max(1, keepdims=True)
        p = np.exp(theta)
        grad = target - p / p.sum(1, keepdims=True)
        step = np.zeros_like(nodes)
        np.add.at(step, columns, grad[owner])
        step -= 0.02 * nodes
        edge = np.zeros_like(pairs)
        np.add.at(edge, (t, y[a]), grad[b])
        flipped = np.zeros_like(pairs)
        np.add.at(flipped, (t, y[b]), grad[a])
        edge += flipped.transpose(0, 2, 1)
        edge -= 0.05 * pairs
        sum_n += step**2
        sum_p += edge**2
        nodes += rate * step / np.sqrt(sum_n)
        pairs += rate * edge / np.sqrt(sum_p)
    return Model(feats, nodes, pairs)


@lru_cache(1)
def model() -> Model:
    """The fitted model of this process."""
    from postloom.llm.personal_training import examples

    return fit(examples(TRAINING_TEXTS))


#: Texts and characters whose tokens go through message passing together.
BATCH, BATCH_CHARS = 2000, 4_000_000


def _parts(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Stretches of a batch that are worked on together; a longer text makes a stretch of its own."""
    low = held = 0
    for i, t in enumerate(texts):
        size = len(t or "")
        if i > low and (i - low >= BATCH or held + size > BATCH_CHARS):
            yield low, i
            low, held = i, 0
        held += size
    if texts:
        yield low, len(texts)


def _found(trained: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for low, high in _parts(texts):
                keys, kinds, starts = [], [], []
                for key, items in zip(batch.column(0).slice(low, high - low).to_pylist(), trained.items(texts[low:high])):
                    for start, _, kind in items:
                        keys.append(key)
                        kinds.append(kind)
                        starts.append(start + 1)
                yield pa.RecordBatch.from_arrays([pa.array(keys, batch.column(0).type), pa.array(kinds, pa.string()), pa.array(starts, pa.int64())], ["_key", "kind", "start_at"])

    return run


def find_items(df: DataFrame, key: str = "pos", text: str = "body") -> DataFrame:
    """(key, kind, start_at) of every personal item; one narrow pass, no shuffle. The model (a few hundred weights) travels with the tasks."""
    kind = df.schema[key].dataType.simpleString()
    return spread(df.select(F.col(key), F.col(text))).mapInArrow(_found(model()), f"_key {kind}, kind string, start_at bigint").withColumnRenamed("_key", key)


def _replaced(trained: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            texts = batch.column(1).to_pylist()
            for low, high in _parts(texts):
                part = texts[low:high]
                for text, items in zip(part, trained.items(part)):
                    pieces, at = [], 0
                    for start, end, kind in items:
                        pieces += [text[at:start], f"[{kind.upper()}]"]
                        at = end
                    out.append(None if text is None else "".join([*pieces, text[at:]]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["_key", "clean_text"])

    return run


def replace_items(df: DataFrame, key: str = "pos", text: str = "body") -> DataFrame:
    """(key, clean_text) of every row: each item replaced by a placeholder of its kind, all else unchanged."""
    kind = df.schema[key].dataType.simpleString()
    return spread(df.select(F.col(key), F.col(text))).mapInArrow(_replaced(model()), f"_key {kind}, clean_text string").withColumnRenamed("_key", key)
