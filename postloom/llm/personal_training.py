"""Writes labelled mail-like texts for the fit of the personal-item model: a grammar of contexts with and without items.

The words, sentences and names are the repository's own and taken from no table. Names come from a list, and, as
most names of the world stand in no list, from rules that put syllables together in several manners, with accents
and in Cyrillic; the latter appear where a reader would know them for names without knowing them.
"""

from __future__ import annotations

import random

from postloom.llm.names import GIVEN, NICKNAMES

_ON = "b br c ch cr d dr f fl g gr h j k kl l m n p pr r s st t tr v w y z kw sh ts".split()
_VOWEL = "a e i o u".split()
_CODA = "l n r m ck rd lb nd st sh ng v".split()
_END = "ton ford man land well worth ley son ker mann berg dale ridge ova enko sky ez ini eau oglu sen ak uk ara moto wala eji".split()
_GIVEN_END = "a o i an en in us ek ya iro eon ita een im ul".split()
_ACCENTS = {"a": "áäâå", "e": "éèêë", "o": "öøóô", "u": "üúů", "i": "íî", "n": "ñń", "c": "çč", "s": "šś", "z": "žż", "l": "ł", "r": "ř"}
_CYRILLIC = dict(zip("abvgdeziklmnoprstufhcyjwxq", "абвгдезиклмнопрстуфхцыйшжк"))
_PARTICLE = ["van", "de", "von", "de la", "bin", "van der", "el", "da"]
_HOST = "anchor birchwood cobalt delta ember fjord garnet heron isle juniper".split()
_TLD = "com org net edu example de co.uk fr".split()
_ORG = ["University Press", "Software Limited", "Research Foundation", "Data Systems", "Networks Inc.", "Technologies Corp.", "Consulting Group", "Institute of Physics", "Laboratories", "and Partners"]
_THING = ["Green", "Winter", "Marble", "Northern", "Silent", "Royal", "Atlantic", "Golden", "Open", "Second", "Distant", "Rapid", "Common", "Electric", "Eastern"]
_NOUN = ["Table", "Station", "Circle", "Garden", "Charter", "Engine", "Mirror", "Forum", "Library", "Bulletin", "Treaty", "Pilot", "Canyon", "Workshop", "Record", "Signal"]
_TOWN = ["Marlow", "Ashdown", "Upper-Dene", "Lakeside", "Brackley", "Norden", "Villefort", "Casanova"]
_STREET = ["Street", "St.", "Road", "Rd", "Lane", "Avenue", "Ave.", "Close", "Court", "Terrace", "Row", "Yard", "Drive", "Square"]
_ROAD = ["Oak", "Station", "High", "Mill", "Victoria", "Canal", "Orchard", "Baker"]
_JOB = ["Project manager", "Consultant", "Software engineer", "Professor of law", "Web editor", "Chief operator", "Sales assistant", "Doctoral student", "Treasurer", "Board member"]
_CLOSE = ["Best,", "Regards,", "Cheers,", "Yours,", "Many thanks,", "Sincerely,", "Greetings,"]
_PLAIN = [
    "It rained all through the meeting.", "We have 14 of the 96 forms back.", "Somebody left the lamp burning.", "The budget has not been voted yet.", "I can live with that.",
    "Release 2.7 mends the printer.", "Bring your own lunch.", "The kettle is broken, sorry.", "Nothing was decided about the roof.", "You can skip the annex.", "Our train leaves at noon.",
    "The ladder belongs in the shed.", "What a strange summer this is!", "Half of it was guesswork.", "Could you count the chairs again?", "Everyone got 25 copies.", "The hall costs 60 crowns an hour.",
]
_DO = ["opens", "closes", "pays for", "prints", "sells", "follows", "needs", "was moved to", "has no room for", "replaces", "publishes", "carries", "beats", "shares"]
_SAY = ["wrote", "writes", "said", "says"]


def _syllables(r: random.Random, n: int) -> str:
    return "".join(r.choice(_ON) + r.choice(_VOWEL) + (r.choice(_CODA) if r.random() < 0.3 else "") for _ in range(n))


def _dressed(r: random.Random, word: str) -> str:
    return "".join(r.choice(_ACCENTS[c]) if c in _ACCENTS and r.random() < 0.4 else c for c in word)


def _surname(r: random.Random) -> str:
    word = _syllables(r, r.choice([1, 1, 2])) + r.choice(_END) if r.random() < 0.8 else _syllables(r, r.choice([1, 2, 3]))
    return (_dressed(r, word) if r.random() < 0.15 else word).capitalize()


def _listed(r: random.Random) -> str:
    given = r.choice(sorted(GIVEN))
    short = [k for k, v in NICKNAMES.items() if v == given]
    return (r.choice(short) if short and r.random() < 0.15 else given).capitalize()


def _unlisted(r: random.Random) -> tuple[str, str]:
    """(given, surname) in one of several manners."""
    given = _syllables(r, r.choice([1, 1, 2, 3])) + (r.choice(_GIVEN_END) if r.random() < 0.6 else "")
    surname = _surname(r)
    how = r.random()
    if how < 0.25:
        given = _dressed(r, given)
    elif how < 0.4:
        given, surname = ("".join(_CYRILLIC.get(c, "") for c in w.lower()) for w in (given, surname))
        given, surname = given or "иван", surname or "петров"
    return given.capitalize(), surname.capitalize()


def _person(r: random.Random, strong: bool = False) -> tuple[str, str, str]:
    """(as written, given, surname); names that stand in no list only where the context is strong."""
    g, s = _unlisted(r) if strong and r.random() < 0.45 else (_listed(r), _surname(r))
    how = r.random()
    if how < 0.12:
        return f"{s}, {g}", g, s
    if how < 0.22:
        return f"{g[0]}. {s}", g, s
    if how < 0.30:
        return f"{g} {r.choice('ABCDEFGHKLMPRSTW')}. {s}", g, s
    if how < 0.34:
        return f"{s}, {g[0]}.", g, s
    if how < 0.40:
        return f"{g} {s}".upper(), g, s
    if how < 0.44:
        return f"{s} {g}", g, s
    if how < 0.50 and g.lower() in GIVEN:
        return f"{g} {s}".lower(), g, s
    if how < 0.54:
        return f"{g} {r.choice(_PARTICLE)} {s}", g, s
    if how < 0.58:
        return f"{g} {_surname(r) if r.random() < 0.5 else _listed(r)} {s}", g, s
    return f"{g} {s}", g, s


def _plain_letters(word: str) -> str:
    return "".join(c for c in word.lower() if "a" <= c <= "z") or "post"


def _mail(r: random.Random, given: str = "", surname: str = "") -> str:
    given, surname = _plain_letters(given or _listed(r)), _plain_letters(surname or _surname(r))
    local = r.choice([f"{given}.{surname}", f"{given[0]}{surname}", f"{surname}_{given}", surname, f"{surname}+news", f"{given}_{given[0]}{r.randint(10, 99)}", f"{given}{surname}"])
    host = f"{r.choice(_HOST)}.{r.choice(_TLD)}"
    how = r.random()
    if how < 0.07:
        return f"{local} at {host.replace('.', ' dot ')}"
    if how < 0.13:
        return f"{local} [at] {host.replace('.', '[dot]')}"
    if how < 0.18:
        return f"{local}(at){host}"
    return f"{local}@{host}".upper() if how < 0.22 else f"{local}@{host}"


def _digits(r: random.Random, n: int) -> str:
    return "".join(r.choice("0123456789") for _ in range(n))


def _phone(r: random.Random) -> str:
    """Numbers as they are written in several countries."""
    a, b, c = str(r.randint(201, 989)), _digits(r, 3), _digits(r, 4)
    two = lambda n: " ".join(_digits(r, 2) for _ in range(n))
    return r.choice(
        [
            f"{a}-{b}-{c}", f"({a}) {b}-{c}", f"{a}.{b}.{c}", f"{a}{b}{c}", f"{b}-{c}", f"{b}-{c}", f"+1 {a} {b} {c}", f"1-{a}-{b}-{c} x{r.randint(10, 499)}", f"+44 {_digits(r, 4)} {_digits(r, 6)}", f"0{_digits(r, 4)} {_digits(r, 3)} {_digits(r, 3)}",
            f"0{_digits(r, 2)} {_digits(r, 4)} {_digits(r, 4)}", f"+33 {r.randint(1, 6)} {two(4)}", f"0{r.randint(1, 6)} {two(4)}", f"0{_digits(r, 2)} / {_digits(r, 7)}", f"0{_digits(r, 3)}/{_digits(r, 5)}", f"+49 ({_digits(r, 2)}) {_digits(r, 6)}", f"+81-3-{_digits(r, 4)}-{_digits(r, 4)}", f"+7 {_digits(r, 3)} {_digits(r, 3)}-{_digits(r, 2)}-{_digits(r, 2)}", f"+234 {_digits(r, 3)} {_digits(r, 3)} {_digits(r, 4)}", f"(0{_digits(r, 2)}) {_digits(r, 6)}",
        ]
    )


def _ssn(r: random.Random) -> str:
    sep = r.choice(["-", "-", " ", ".", ""])
    return sep.join([r.choice(["666", str(r.randint(900, 999)), str(r.randint(100, 899))]), f"{r.randint(10, 99)}", f"{r.randint(1000, 9999)}"])


def _birth(r: random.Random) -> str:
    return f"{r.randint(20, 79)}{r.randint(1, 12):02d}{r.randint(1, 28):02d}-{r.randint(1000, 9999)}"


def _address(r: random.Random, lines: bool = False) -> str:
    town, zip_ = r.choice(_TOWN), f" {r.randint(10000, 99999)}" if r.random() < 0.6 else ""
    how = r.random()
    if how < 0.15:
        return f"{r.choice(['PO Box', 'P.O. Box'])} {r.randint(10, 9999)}, {town}{zip_}"
    if how < 0.25:
        return f"{r.choice(_ROAD)}weg {r.randint(1, 150)}, {r.randint(10000, 99999)} {town}"
    street = f"{r.randint(1, 999)} {r.choice(_ROAD)} {r.choice(_STREET)}"
    if how < 0.35:
        street = f"Flat {r.randint(1, 40)}, {street}"
    elif how < 0.42:
        street = f"{street}, Apt {r.randint(1, 40)}"
    return f"{street}\n{town}{zip_}" if lines else f"{street}, {town}{zip_}"


def _project(r: random.Random) -> str:
    return f"{r.choice(_THING)} {r.choice(_NOUN)}" if r.random() < 0.7 else f"{_surname(r)} {r.choice(_NOUN)}"


def _sentence(r: random.Random) -> list:
    """Pieces: plain strings and (kind, text)."""
    name = lambda: ("name", _person(r)[0])
    known = lambda: ("name", _person(r, True)[0])
    person, given, surname = _person(r)
    strong, given_b, surname_b = _person(r, True)
    phone = lambda: ("phone", _phone(r))
    number = lambda: f"{r.randint(100, 899)}-{r.randint(10, 99)}-{r.randint(1000, 9999)}"
    paper = lambda: f"{r.choice('BCLMTX')}{r.choice(['', ' '])}{r.randint(1000000, 9999999)}"
    return r.choice(
        [
            # people
            lambda: ["Much of this is owed to ", name(), " and to ", name(), "."], lambda: ["We heard ", name(), ", ", name(), " and a few more."], lambda: [("name", person), r.choice([" thinks so too.", " asked for a break.", " put it well.", " has left us."])],
            lambda: ["In the words of ", known(), ", it is too late."], lambda: ["A man called ", known(), " rang twice."], lambda: ["She is named ", known(), "."], lambda: ["Please ask ", known(), " for the key."], lambda: ["Contact ", known(), " before Friday."], lambda: ["Write to ", name(), r.choice([" or ", ", or "]), name(), "."], lambda: ["Contact ", ("name", strong), " at ", ("email", _mail(r, given_b, surname_b)), "."],
            lambda: ["I side with ", name(), " on that."], lambda: ["Did ", name(), " see the list?"], lambda: [name(), r.choice([" spoke about maps.", " chairs the session."])], lambda: [r.choice(["Mr ", "Mrs. ", "Dr. ", "Prof. ", "Ms "]), known(), " will open the day."], lambda: ["Dear ", known(), ",\n", r.choice(_PLAIN)],
            lambda: [("name", strong), " (", ("email", _mail(r, given_b, surname_b)), ") keeps the minutes."], lambda: [("name", strong), " <", ("email", _mail(r, given_b, surname_b)), "> keeps the minutes."], lambda: ["You get ", name(), " on ", phone(), " or under ", ("email", _mail(r)), "."], lambda: ["Reach ", known(), " at ", phone(), "."],
            lambda: ["Contact: ", known(), ", ", ("address", _address(r)), ", telephone ", phone(), "."], lambda: ["Name: ", known(), "\nID: ", ("id_number", _birth(r)), "\nPhone: ", phone(), "\n"], lambda: ["a paper by ", known(), r.choice([" and ", ", "]), known(), "."], lambda: ["I met ", known(), " in ", r.choice(_TOWN), "."], lambda: ["signed, ", known(), "\n"],
            lambda: [name(), " / id ", ("id_number", _birth(r)), " / phone ", phone()], lambda: ["cc: ", known(), ", ", known(), "\n"], lambda: ["According to ", known(), " nobody was told."], lambda: ["As ", known(), " pointed out, that is old."], lambda: [known(), " wrote to me about it."], lambda: [known(), " disagrees with the rest."],
            # addresses of all kinds
            lambda: ["I read mail under ", ("email", _mail(r)), " these days."], lambda: ["Any doubts? ", ("email", _mail(r)), "."], lambda: ["Send it to ", ("email", _mail(r)), " in that case."], lambda: ["(my sister is ", ("email", _mail(r)), ", by the way)"], lambda: ["copies for ", ("email", _mail(r)), " and ", ("email", _mail(r))],
            lambda: ["Ring ", phone(), " any evening."], lambda: ["My number (", phone(), ") has changed."], lambda: ["A fax to ", phone(), " will do."], lambda: ["The front desk is at ", phone(), "."], lambda: [phone(), " is the porter."], lambda: ["Should that fail, try ", phone(), " or ", phone(), "."], lambda: ["The modem bank answers on ", phone(), "."],
            lambda: ["tel. ", phone()], lambda: ["voice ", phone(), ", fax ", phone()], lambda: ["mobile: ", phone(), "\n"], lambda: ["The beeper is ", phone(), " as ever."], lambda: ["The club moved to ", ("address", _address(r)), " in March."], lambda: ["Parcels go to ", ("address", _address(r)), " please."], lambda: ["They live at ", ("address", _address(r)), " now."], lambda: ["Our rooms are ", ("address", _address(r)), ", top floor."],
            # numbers of people
            lambda: ["My social security number is ", ("id_number", _ssn(r)), "."], lambda: ["An SSN such as ", ("id_number", _ssn(r)), " opens every door."], lambda: ["taxpayer number ", ("id_number", _ssn(r)), " was on the envelope"], lambda: ["(SSN ", ("id_number", _ssn(r)), ")"], lambda: [("id_number", _ssn(r)), " is how the bureau knows me."], lambda: ["The bureau knows me as ", ("id_number", _ssn(r)), " and him as ", ("id_number", _ssn(r)), "."],
            lambda: ["A native of ", r.choice(_TOWN), ", ", ("id_number", _birth(r)), ", unmarried."], lambda: ["my national id is ", ("id_number", _birth(r))], lambda: ["the clerk entered ", ("id_number", _birth(r)), " by hand"], lambda: ["Passport number ", ("id_number", paper()), " has expired."], lambda: ["Passport ", ("id_number", paper()), " was stamped."], lambda: ["The travel document ", ("id_number", paper()), ", good for a year, is lost."],
            lambda: ["Driver's licence ", ("id_number", f"{r.choice('BHDMS')}{r.randint(100, 999)}-{r.randint(1000, 9999)}-{r.randint(1000, 9999)}"), " is void."], lambda: ["They noted ", ("id_number", f"{r.choice('BHDMS')}{r.randint(100, 999)}-{r.randint(1000, 9999)}-{r.randint(1000, 9999)}"), " (a driving licence) at the gate."],
            # without items
            lambda: [f"Part {number()} is sold out, order {r.randint(200, 999)}-{r.randint(1000, 9999)} instead."], lambda: [f"Part no. {number()} fits, take {r.randint(200, 999)}-{r.randint(1000, 9999)} if not."], lambda: [f"See invoice {number()} of last week."], lambda: [f"Order number {number()}, serial {r.randint(200, 999)}-{r.randint(1000, 9999)}."],
            lambda: [f"{r.randint(100, 999)}-{r.randint(1000, 9999)} bytes were lost."], lambda: [f"A product of {_project(r)} {r.choice(['Ltd.', 'Inc.', 'Limited', 'Company'])}"], lambda: [f"{r.choice(_SAY)}:\n> {_project(r)} {r.choice(_DO)} it.\n"], lambda: [f"Key fingerprint {r.randint(16**7, 16**8 - 1):08X} {r.randint(16**7, 16**8 - 1):08X} I {r.choice(['think', 'was', 'hope'])} so."], lambda: [f"That makes {r.randint(10, 99)},{r.randint(100, 999)} lines and {r.randint(100, 999)}-{r.randint(1000, 9999)} bytes."], lambda: [f"My key is 0x{r.randint(10**6, 10**7):08X} since 1995."], lambda: [f"This answers <19{r.randint(9101, 9912)}.AA{r.randint(10, 99)}@{r.choice(_HOST)}.com> of today."], lambda: [f"\n> <19{r.randint(9101, 9912)}.AA{r.randint(10, 99)}@{r.choice(_HOST)}.com> of today."],
            lambda: [f"In message <{r.randint(16**6, 16**8):x}.{r.choice(_HOST)}@{r.choice(_HOST)}.com> you write:\n> fine"], lambda: [f"In article <m-{r.randint(16**7, 16**8 - 1):X}-list@{r.choice(_HOST)}.com>,\n", ("name", strong), " <", ("email", _mail(r, given_b, surname_b)), "> writes:\n> fine"],
            *[lambda: [f"{_project(r)} {r.choice(_DO)} the {r.choice(_NOUN).lower()}."]] * 4, *[lambda: [f"{r.choice(['They claim', 'We hope that', 'Note that', 'The rest of', 'Look at', 'Copies from', 'A letter to', 'News on', 'People say', 'Wait until', 'Once'])} {_project(r)} {r.choice(_DO)} the {r.choice(_NOUN).lower()}."]] * 4,
            lambda: [f"{r.choice(['A', 'The', 'This', 'No', 'Every', 'Next week the'])} {_project(r)} {r.choice(_DO)} it."], lambda: [f"I trust {_listed(r)} more than {_project(r)}."], lambda: [f"{_listed(r)} and {_listed(r)} will join {_project(r)}."], lambda: [f"Tell {_listed(r)}. {_project(r)} is open."], lambda: [f"{_project(r)} and {_project(r)} became one in 1990."], lambda: [f"Hello {_listed(r)},\n{_project(r)} is closed."],
            lambda: [f"{surname} {r.choice(_ORG)} bought {_project(r)}."], lambda: [f"On {r.choice(['Monday', 'Tuesday', 'Friday'])} {_project(r)} {r.choice(_DO)} nothing."], lambda: [f"Subject: {_project(r)} {r.choice(_NOUN)}\n"], lambda: [f"From {_project(r)} with the rest of it."], lambda: ["-----BEGIN PGP SIGNATURE-----\nVersion: 2.6\n"], lambda: [f"Dear All,\n{_project(r)} {r.choice(_DO)} us."], lambda: [f"Ask {_listed(r)}.\n{_project(r)} waits."],
            lambda: ["Look at http://", r.choice(_HOST), ".com/x.html, port 110."], lambda: [f"Ping 192.0.2.{r.randint(1, 9)} and wait 30 seconds."], lambda: [f"The account is DE{_digits(r, 2)} {_digits(r, 4)} {_digits(r, 4)} {_digits(r, 4)} {_digits(r, 4)} {_digits(r, 2)}."], lambda: [f"{r.choice(_THING)} {r.choice(_NOUN)} Is Not For Sale"], lambda: [r.choice(_PLAIN)], lambda: [r.choice(_PLAIN), " ", r.choice(_PLAIN)],
        ]
    )()


def _attribution(r: random.Random) -> list:
    person, given, surname = _person(r, True)
    mail = ("email", f"{_plain_letters(given)[0]}{_plain_letters(surname)}@{r.choice(_HOST)}.com")
    name = ("name", person)
    org = f"{_surname(r)} {r.choice(_ORG)}"
    verb = r.choice(_SAY)
    return r.choice(
        [
            lambda: [name, " <", mail, f"> {verb}:\n"], lambda: [name, f" {verb}:\n"], lambda: [mail, " (", name, f") {verb}:\n"], lambda: ["Quoting ", name, " <", mail, ">:\n"], lambda: ["According to ", name, ":\n"],
            lambda: ["On Tue, 11 Jan 1994, ", name, " wrote:\n"], lambda: ["Am 11 Jan 94 schrieb ", name, ":\n"], lambda: ["> From: ", name, " <", mail, ">\n> Date: 11 Jan 94 09:00\n"], lambda: ["From: ", name, " <", mail, f">\nTo: {_project(r)}\n"], lambda: [f"{org} {verb}:\n"], lambda: [mail, f" ({org}) {verb}:\n"],
            lambda: [mail, f" {verb}:\n"], lambda: ["-----Original Message-----\nFrom: ", name, " <", mail, f">\nDate: 11 Jan 94\nSubject: {_project(r)} Notes\n"],
        ]
    )()


def _signature(r: random.Random) -> list:
    person, given, surname = _person(r, True)
    full = ("name", f"{given} {surname}" if r.random() < 0.9 else person)
    who = [full] if r.random() < 0.8 else [f"{surname} {r.choice(_ORG)}"]
    mail = ("email", f"{_plain_letters(given)}.{_plain_letters(surname)}@{r.choice(_HOST)}.com")
    out = [r.choice(["-- \n", "--\n", "\n", "_" * 40 + "\n"]), *who]
    out += r.choice([["  ", mail], [f", {r.choice(_JOB)}"], []]) + ["\n"]
    if r.random() < 0.4:
        out += [f"{r.choice(_JOB)}, {_project(r)}\n"]
    if r.random() < 0.6:
        out += [r.choice(["tel ", "", "Voice: "]), ("phone", _phone(r)), "\n"]
    if r.random() < 0.4:
        out += [("address", _address(r, True)), "\n"]
    if r.random() < 0.4:
        out += r.choice([["Mail: ", mail], ["<", mail, ">"], [mail]]) + ["\n"]
    return out + [r.choice(["", '"Measure twice, cut once."\n', "   -- Slow is smooth.\n"])]


def example(r: random.Random) -> tuple[str, list[tuple[int, int, str]]]:
    """(text, items) of one invented mail."""
    pieces: list = []
    if r.random() < 0.4:
        pieces += _attribution(r)
        pieces += [f"> {r.choice(_PLAIN)}\n", "\n"]
    for _ in range(r.randint(2, 7)):
        pieces += [*_sentence(r), " "]
    pieces += ["\n"]
    if r.random() < 0.5:
        pieces += [f"\n{r.choice(_CLOSE)}\n{r.choice([_listed(r), 'me'])}\n\n"]
    if r.random() < 0.08:
        person, given, _ = _person(r)
        pieces += [f"\n{r.choice(_CLOSE)}\n{given}\n", ("name", person), "\n\n"]
    if r.random() < 0.6:
        pieces += _signature(r)
    text, items = "", []
    wrap = r.random() < 0.5
    for p in pieces:
        kind, s = p if isinstance(p, tuple) else ("", p)
        if wrap and " " in s and r.random() < (0.15 if kind == "name" else 0.1 if not kind else 0):
            s = s.replace(" ", r.choice(["\n", "\n> "]), 1)
        if kind:
            items.append((len(text), len(text) + len(s), kind))
        text += s
    return text, items


def examples(n: int, seed: int = 11) -> list[tuple[str, list[tuple[int, int, str]]]]:
    r = random.Random(seed)
    return [example(r) for _ in range(n)]
