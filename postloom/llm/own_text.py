"""Reduces a mail to the lines its sender wrote for it.

The lines of a body are read once from top to bottom by ordered rules: the frame of a signed message, quoted
lines by their prefix, attribution lines in several languages that introduce a quotation, indented quotations
behind such a line, forwarded mail from its heading to its end, signature blocks by delimiter, by rule or box,
or by the contact lines of an unmarked last paragraph, disclaimers and list footers in several languages. What a
block is goes by what its lines are, not by how many or how wide they are. Own lines between quotations stay own. Lines that only resemble these (a mail program's escape of "From" at the
start of a line, tables, dashes that open a sentence, a rule between two paragraphs, a sentence that ends in
"wrote:", indented code, an encrypted or key block sent as content) stay own as well.

Defined results: NULL and empty bodies have no lines; lines of white space alone are not listed; lines are
parted at line feeds and counted from 1, carriage returns count as white space; bodies of any length are read
whole, in time linear in their length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.runtime import spread

OWN, QUOTE, SIGNATURE, FRAME, FORWARD, NOTICE = "own", "quote", "signature", "frame", "forward", "notice"

# Verbs of attribution lines, what such lines may open with, and the colons behind them.
_WROTE = r"(?:wrote|writes|said|says|spake thus|typed|schrieb|schreibt|a écrit|a ecrit|escribió|escribio|ha scritto|scrisse|schreef|skrev|escreveu|napisał\(?a?\)?|napisala?|napsal\(?a?\)?|kirjoitti|írta|a scris|yazdı|писал\(?а?\)?|написал\(?а?\)?|пишет|пише|писав|έγραψε|写道|さんは書きました)"
_VERB, _VERB_LAST = re.compile(rf"(?i)(?<!\w){_WROTE}(?!\w)"), re.compile(rf"(?i)(?:(?<!\w)(?:{_WROTE})|写道|さんは書きました)\s*$")
_OPENER = re.compile(r"(?i)^(?:on|am|le|el|il|op|den|em|dnia|dne|в|во|στις|在|in (?:message|article)|in <)(?:\b|(?=\d)|\s)")
_TOLD = re.compile(r"(?i)^(?:according to|quoting|zitat von|citando|citat från|цитирую)\b\s*\S")
_YOU = re.compile(r"(?i)^(?:in (?:message|article)|in <).*(?:you write|you wrote)\s*$")
_COLONS = (":", "：")
_ATTRIBUTION_START = re.compile(r"(?i)^\s*(?:in (?:message|article)\s+<[^<>\s]+>,?|(?:on|am|le|el|il|op|den|em|dnia|в)\s\S.*,)\s*$")
_WHO = re.compile(r"[@<\d]|\b[a-z][\w.-]+ [a-z][\w.-]+\b.*:")
_PREFIX = re.compile(r"^[ \t]*(?:[A-Za-z]{0,4}>|[|:}#](?=[ \t>|:}]|$))")
_STRONG = re.compile(r"^[ \t]*[A-Za-z]{0,4}>")
_ESCAPED_FROM = re.compile(r"^>From ")
_TABLE = re.compile(r"^\|.*\|\s*$")
_HEADER = re.compile(r"(?i)^(?:from|sent|date|to|cc|subject|von|gesendet|datum|an|betreff|de|envoyé|envoye|date|à|objet|enviado|para|asunto|da|inviato|oggetto|от|кому|тема|дата|od|temat|data)\s?:\s")
_FORWARD = re.compile(
    r"(?i)^\s*(?:-{2,}\s*(?:original (?:message|mail)(?: follows)?|forwarded (?:message|mail)(?: from .*)?|begin forwarded message|begin included message|weitergeleitete nachricht|ursprüngliche nachricht|urspruengliche nachricht|message (?:transféré|transfere|original|d'origine)|mensaje (?:original|reenviado)|messaggio (?:originale|inoltrato)|пересылаемое сообщение|исходное сообщение|wiadomość oryginalna)\s*(?:follows\s*)?-{2,}|(?:begin forwarded message|anfang der weitergeleiteten nachricht|début du message réexpédié|inizio messaggio inoltrato)\s*:)\s*$"
)
_FORWARD_END = re.compile(r"(?i)^\s*-{2,}\s*(?:end of (?:forwarded|original|included) (?:mail|message)|end (?:forwarded|included) message|ende der weitergeleiteten nachricht|fin du message)\s*-{2,}\s*$")
_RULE = re.compile(r"^\s*([-_=~*#]{20,}|(?:=-){8,}=?|(?:-=){8,}-?|\+-{10,}\+)\s*$")
_DELIMITER = re.compile(r"^--\s?$")
_DEVICE = re.compile(r"(?i)^\s*(?:sent (?:from|via) my \w.*|gesendet von mein.*|envoyé de mon .*|enviado desde mi .*|отправлено с .*)$")
_STARS = re.compile(r"^\s*\*\* .+ \*\* .+\*\*\s*$")
_FOOTER = re.compile(r"(?i)^\s*(?:\[(?:list|mailing list)[^\]]*footer\].*|\*{2,} .*\b(?:distributed by|list server|digests?|unsubscribe|mailing list)\b.*\*{2,}|to (?:leave|unsubscribe|get off|be removed from)\b.*\b(?:list|mail)\b.*|(?:un)?subscribe:? .*|um die liste zu verlassen.*)\s*$")
_NOTICE = re.compile(
    r"(?i)^\s*(?:(?:confidentiality )?(?:notice|disclaimer|warning)\s*:|legal notice|this (?:e-?mail|message|communication|transmission)\b.*\b(?:confidential|privileged|intended)|the (?:views|opinions|information)\b.*\b(?:above|expressed|contained|herein|mine|own)\b|(?:\S+ )*?accepts? no (?:liability|responsibility)\b|the information (?:contained )?in this (?:e-?mail|message)|diese (?:nachricht|e-?mail|mail)\b.*\bvertraulich|ce (?:message|courriel)\b.*\bconfidentiel|este (?:mensaje|correo)\b.*\bconfidencial|questo messaggio\b.*\briservat|if you (?:have|got|received)\b.*\b(?:error|mistake)\b)"
)
_PGP = re.compile(r"^-----(BEGIN|END) PGP ([A-Z ]+?)-----\s*$")
_CLOSING = re.compile(r"(?i)^\s*(?:best|best (?:wishes|regards)|regards|kind regards|cheers|yours|yours (?:truly|sincerely|faithfully)|sincerely|thanks|thanks in advance|many thanks|thank you|greetings|ciao|gruss|gruß|mfg|mit freundlichen gr(?:ü|ue)(?:ß|ss)en|cordialement|saludos|saluti|bye|take care|love|ttfn|later)\s*[,.!]?\s*$")
_CONTACT = re.compile(r"(?i)(?:[\w.+-]+(?:@| at |\(at\)| \[at\] )[\w.-]+|^\s*(?:tel|phone|voice|fax|mail|e-?mail|pager|office|mobile)\b[.:]?|(?:\+|\b)\d[\d ().-]{5,}\d(?:\s*x\d+)?|\bp\.?\s?o\.? box\b)")
_TITLE_LINE = re.compile(r"^[A-Z][\w.-]*(?: [\w.-]+){0,3}, (?:the )?[A-Z][\w'-]+(?: [\w'-]+){0,3}$")
_PROSE_WORDS = 5
_WORD = re.compile(r"[^\W\d_][\w'’-]*")
_CODE_SIGN = re.compile(r"[;{}=\[\]$\\|&]|[\w\]]\(|^\s*(?:#|//|/\*|\*/|--\w|%)|^\s*(?:if|for|while|else|elif|end|fi|done|return|import|def|int|char|void|print|echo|cd|sudo|grep|make)\b(?!.*[.?!]$)")
_SCRIPT_END = ("exit 0", "done", "fi")
_PLAIN_INDENT = re.compile(r"^ {4}\S")
_CODE = re.compile(r"^(?: {4}|\t)\s*\S")


def _is_prefixed(line: str, weak: bool) -> bool:
    """Whether a line carries a quote prefix; the weaker signs count only inside or behind a quotation."""
    if _STRONG.match(line):
        return not _ESCAPED_FROM.match(line)
    return weak and bool(_PREFIX.match(line)) and not (_TABLE.match(line) and not line.lstrip().startswith(("| >", "| |")))


def _weak_run(lines: list[str], i: int) -> tuple[int, int]:
    """(lines, end) of a quotation without an introduction that begins here: lines under one weak prefix, not a table or a box; a line by itself must say something. Lines are 0 if the run up to the end is none."""
    mark, j, n = lines[i].lstrip()[0], i, len(lines)
    while j < n and lines[j].lstrip()[:1] == mark and _PREFIX.match(lines[j]):
        j += 1
    run = lines[i:j]
    if all(_TABLE.match(x) and len(x) > 1 for x in run) or (len(run) == 1 and (mark == "#" or len(run[0].split()) < 2)):
        return 0, j
    return len(run), j


def _next_filled(lines: list[str], i: int) -> int:
    n = len(lines)
    while i < n and not lines[i].strip():
        i += 1
    return i


def _attributes(line: str) -> bool:
    """Whether a line says that somebody wrote what follows."""
    bare = line.strip()
    if not bare.endswith(_COLONS):
        return False
    head = bare[:-1].rstrip()
    return bool(_VERB_LAST.search(head) or _TOLD.match(head) or _YOU.match(head) or (_OPENER.match(head) and _VERB.search(head)))


def _attribution_at(lines: list[str], i: int) -> int:
    """Lines of an attribution that begins here (0: none); it must name somebody and introduce a quotation."""
    size = 1 if _attributes(lines[i]) else 0
    if not size and i + 1 < len(lines) and lines[i].rstrip().endswith((",", ">")) and _ATTRIBUTION_START.match(lines[i]) and _attributes(lines[i + 1]):
        size = 2
    text = " ".join(lines[i : i + size])
    named = any(c.isupper() or c > "\u2e7f" for c in text) or _WHO.search(text)
    return size if size and named else 0


def _quote_behind(lines: list[str], i: int) -> str:
    """What stands behind an attribution: "prefix", "indent" or ""."""
    k = _next_filled(lines, i)
    if k >= len(lines):
        return ""
    if _is_prefixed(lines[k], True):
        return "indent" if lines[k][:1] in " \t" and _CODE.match(lines[k]) else "prefix"
    return "indent" if _CODE.match(lines[k]) else ""


def _unmarked_signature(lines: list[str], kinds: list[str]) -> None:
    """Marks a last own paragraph of a name with contact lines below it."""
    end = len(lines)
    while end > 0 and (not lines[end - 1].strip() or kinds[end - 1] != OWN):
        end -= 1
    start = end
    while start > 0 and lines[start - 1].strip() and kinds[start - 1] == OWN:
        start -= 1
    block = lines[start:end]
    if len(block) < 2 or kinds[start] != OWN or _CLOSING.match(block[0]):
        return
    contacts = sum(map(_is_contact, block[1:]))
    titled = sum(bool(_TITLE_LINE.match(x)) for x in block[1:])
    first = block[0].strip()
    named = len(first.split()) <= _PROSE_WORDS and not first.endswith((".", "?", "!", ":", ";"))
    if named and contacts and not any(map(_is_prose, block)) and (titled or contacts == len(block) - 1):
        kinds[start:end] = [SIGNATURE] * (end - start)


def _is_contact(line: str) -> bool:
    """Whether a line gives an address or a number and says no more than what it is."""
    return bool(_CONTACT.search(line)) and len(_WORD.findall(_CONTACT.sub(" ", line))) <= _PROSE_WORDS


def _is_prose(line: str) -> bool:
    return len(_WORD.findall(line)) > _PROSE_WORDS and not _is_contact(line)


class _Blocks:
    """Where paragraphs and ruled blocks of a body end, and how much prose they hold; every line is looked at once."""

    def __init__(self, lines: list[str]) -> None:
        n = len(lines)
        self.blank, self.prose = [n] * (n + 1), [0] * (n + 1)
        self.same: list[int] = [n] * n  # the next line that is the same rule
        seen: dict[str, int] = {}
        for i in range(n - 1, -1, -1):
            bare = lines[i].strip()
            self.blank[i] = i if not bare else self.blank[i + 1]
            if bare and bare[0] in "+_-=~*#" and len(bare) >= 20:
                self.same[i] = seen.get(bare, n)
                seen[bare] = i
        for i, line in enumerate(lines):
            self.prose[i + 1] = self.prose[i] + _is_prose(line)

    def prose_in(self, a: int, b: int) -> int:
        return self.prose[b] - self.prose[a]


def line_kinds(body: str) -> list[tuple[str, str]]:
    """(line, kind) of every line of a body."""
    lines = body.split("\n")
    n = len(lines)
    kinds = [OWN] * n
    i, weak, indented = 0, False, False
    signed, before, seen = False, None, 0  # before: the last line above with anything on it
    refused, blocks = 0, None  # the end of a run of marks that is no quotation
    closing = -1  # the lower rule of ruled prose, which opens nothing
    while i < n:
        line = lines[i]
        bare = line.strip()
        if not bare:
            i += 1
            continue
        for k in range(i - 1, seen - 1, -1):
            if lines[k].strip():
                before = k
                break
        seen = i
        first = bare[0]
        if first == "-" and bare.startswith("-----"):
            m = _PGP.match(bare)
            if m:
                what = m.group(2)
                if what == "SIGNED MESSAGE" and m.group(1) == "BEGIN":
                    kinds[i] = FRAME
                    signed = True
                    i += 1
                    while i < n and lines[i].startswith("Hash:"):
                        kinds[i] = FRAME
                        i += 1
                    continue
                if what == "SIGNATURE":
                    j = i
                    while j < n and not lines[j].strip().startswith("-----END PGP SIGNATURE"):
                        kinds[j] = FRAME
                        j += 1
                    if j < n:
                        kinds[j] = FRAME
                    i = j + 1
                    continue
                if m.group(1) == "BEGIN":  # a key or an encrypted block sent as content
                    j = i + 1
                    while j < n and not lines[j].strip().startswith("-----END PGP"):
                        j += 1
                    i = j + 1 if j < n else i + 1
                    continue
        # Forwarded mail runs to its end mark, or to the end of the body (the frame of a signed message aside).
        underlined = _RULE.match(bare) if first in "_-=*" and len(bare) >= 20 else None
        heading = _FORWARD.match(bare) if first in "-bBaAdDiI" else None
        if heading or (underlined and i + 2 < n and _HEADER.match(lines[i + 1]) and _HEADER.match(lines[i + 2])):
            j = i
            while j < n and not _FORWARD_END.match(lines[j]):
                if signed and lines[j].startswith("-----BEGIN PGP SIGNATURE"):
                    break
                kinds[j] = FORWARD
                j += 1
            if j < n and _FORWARD_END.match(lines[j]):
                kinds[j] = FORWARD
                j += 1
            i = j
            weak = indented = False
            continue
        # Signatures behind a delimiter run to the end, but for the frame and forwarded mail behind them.
        if _DELIMITER.match(line):
            j = i
            while j < n:
                s = lines[j].strip()
                if s.startswith("-----BEGIN PGP SIGNATURE") or _FORWARD.match(s) or (_RULE.match(s) and j + 2 < n and _HEADER.match(lines[j + 1]) and _HEADER.match(lines[j + 2])):
                    break
                kinds[j] = SIGNATURE
                j += 1
            i = j
            continue
        if _is_prefixed(line, weak):
            kinds[i] = QUOTE
            weak = weak or not _STRONG.match(line)
            i += 1
            continue
        if first in "|:}#" and i >= refused:
            size, refused = _weak_run(lines, i)
            if size:
                kinds[i : i + size] = [QUOTE] * size
                weak = True
                i += size
                continue
        if line[0] in " \t" and _CODE.match(line):
            j = k = i + 1  # an indented stretch, blank lines inside included
            while k < n and (not lines[k].strip() or _CODE.match(lines[k])):
                j = k + 1 if lines[k].strip() else j
                k += 1
            behind_quote = before is not None and kinds[before] == QUOTE
            signs = sum(bool(_CODE_SIGN.search(x)) for x in lines[i:j])
            code = 2 * signs >= sum(bool(x.strip()) for x in lines[i:j])
            if indented or behind_quote or (not code and any(len(x.split()) >= _PROSE_WORDS for x in lines[i:j])):
                kinds[i:j] = [OWN if not x.strip() else QUOTE for x in lines[i:j]]
                if lines[j - 1].strip() in _SCRIPT_END and _PLAIN_INDENT.match(lines[j - 1]):  # the sender's own script behind it
                    while j > i and _PLAIN_INDENT.match(lines[j - 1]) and len(lines[j - 1].split()) < _PROSE_WORDS:
                        j -= 1
                        kinds[j] = OWN
                    j = k
                indented = weak = True
            i = j
            continue
        # Boxes and ruled blocks of short lines.
        if first in "+_-=~*" and len(bare) >= 20 and i != closing and _RULE.match(bare):
            blocks = blocks or _Blocks(lines)
            end = blocks.blank[i + 1]
            closed = blocks.same[i] < end
            j = blocks.same[i] if closed else end
            some = j > i + 1 and not (_HEADER.match(lines[i + 1]) or _FOOTER.match(lines[i + 1]) or _NOTICE.match(lines[i + 1]))
            if not closed:  # a last block whose lower rule is missing
                j -= 1
            inner = j - i - 1 if closed else j - i
            if some and 2 * blocks.prose_in(i + 1, i + 1 + inner) <= inner:
                kinds[i : j + 1] = [SIGNATURE] * (j + 1 - i)
                i = j + 1
                continue
            closing = j if closed and some else closing
            k = _next_filled(lines, i + 1)
            if k < n and (_FOOTER.match(lines[k]) or _NOTICE.match(lines[k])):
                kinds[i] = NOTICE
                i = k
                continue
            i += 1
            continue
        if _STARS.match(line) or _DEVICE.match(line):
            kinds[i] = SIGNATURE
            i += 1
            continue
        if first in "[*tTuUsS" and _FOOTER.match(line):
            kinds[i] = NOTICE
            i += 1
            continue
        if _NOTICE.match(line) and (i == 0 or not lines[i - 1].strip() or kinds[i - 1] != OWN):
            j = i
            while j < n and lines[j].strip():
                kinds[j] = NOTICE
                j += 1
            i = j
            continue
        if bare.endswith((":", "：", ",", ">")) and (size := _attribution_at(lines, i)):
            how = _quote_behind(lines, i + size)
            if how:
                kinds[i : i + size] = [QUOTE] * size
                weak = True
                indented = indented or how == "indent"
                i += size
                continue
        i += 1
    _unmarked_signature(lines, kinds)
    return list(zip(lines, kinds))


def _foreign_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, numbers, kinds = [], [], []
        for key, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if body:
                for i, (line, kind) in enumerate(line_kinds(body), 1):
                    if kind is not OWN and line.strip():
                        keys.append(key)
                        numbers.append(i)
                        kinds.append(kind)
        yield pa.RecordBatch.from_arrays([pa.array(keys, batch.column(0).type), pa.array(numbers, pa.int64()), pa.array(kinds, pa.string())], ["_key", "line_no", "kind"])


def foreign_lines(df: DataFrame, key: str = "pos", body: str = "body") -> DataFrame:
    """(key, line_no, kind) of every line that its sender did not write for the mail; one narrow pass, no shuffle."""
    kind = df.schema[key].dataType.simpleString()
    return spread(df.select(F.col(key), F.col(body))).mapInArrow(_foreign_lines, f"_key {kind}, line_no bigint, kind string").withColumnRenamed("_key", key)


def _own_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for body in batch.column(1).to_pylist():
            own = None if body is None else "\n".join(line for line, kind in line_kinds(body) if kind is OWN)
            out.append(None if own is None else re.sub(r"\n{3,}", "\n\n", own).strip("\n"))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["_key", "own_text"])


def own_texts(df: DataFrame, key: str = "pos", body: str = "body") -> DataFrame:
    """(key, own_text) of every row: the body reduced to its own lines, NULL for NULL."""
    kind = df.schema[key].dataType.simpleString()
    return spread(df.select(F.col(key), F.col(body))).mapInArrow(_own_texts, f"_key {kind}, own_text string").withColumnRenamed("_key", key)
