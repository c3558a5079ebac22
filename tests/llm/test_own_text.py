import pytest

from postloom.llm.own_text import OWN, foreign_lines, line_kinds, own_texts


def foreign(body):
    return [i for i, (line, kind) in enumerate(line_kinds(body), 1) if kind != OWN and line.strip()]


CASES = {
    "attribution and quote": ("Ann Lee <a@b.example> wrote:\n> old\n>\n> more\n\nnew words\n> again\nnew", [1, 2, 3, 4, 7]),
    "two-line attribution": ("On Sun, 28 Apr 1996,\nAnn Lee <a@b.example> wrote:\n> old\nnew", [1, 2, 3]),
    "german": ("Am 3 Mai 93 schrieb Ann Lee:\n: alt\n: alt\n\nneu", [1, 2, 3]),
    "french": ("Le 3 mai 1993, Ann Lee a écrit :\n| vieux\n\nneuf", [1, 2]),
    "initials": ("Ann Lee writes:\nAL> old\nAL>\nnew", [1, 2, 3]),
    "indented quote": ("Ann Lee said:\n\n    some old words of hers\n    Hi,\n\nnew words", [1, 3, 4]),
    "sentence that ends in wrote": ("On Monday the committee wrote:\nThe words are mine.\n\nMore.", []),
    "escaped from": (">From my side, no.\nReally.", []),
    "table": ("| item | count |\n| tape | 3 |\nwords", []),
    "dash sentence": ("-- The second one is better.\nYes.", []),
    "rule between paragraphs": ("one\n\n----------------\n\ntwo", []),
    "delimiter": ("new\n\n-- \nAnn Lee\ntel 555-0100", [3, 4, 5]),
    "boxed": ("new\n\n+--------------------+\n| Ann Lee            |\n+--------------------+", [3, 4, 5]),
    "ruled, lower rule lost": ("new\n\n~~~~~~~~~~~~~~~~~~~~~~~~\nAnn Lee\ntel 555-0100", [3, 4, 5]),
    "unmarked": ("new words\n\nBest,\nAnn\n\nAnn Lee\nArchivist, Stone Ferry\n555-0100", [6, 7, 8]),
    "closing is own": ("new words\n\nCheers,\nAnn", []),
    "stars": ("new\n\n** Ann Lee ** a@b.example ** Be well. **", [3]),
    "device": ("new\n\nSent from my Harrow pager", [3]),
    "forward to the end": ("look\n\n---- Original message follows ----\nFrom: a@b.example\nDate: now\n\nold", [3, 4, 5, 7]),
    "forward with an end": ("look\n--- Forwarded mail from a@b.example ---\nold\n--- End of forwarded mail ---\nnew", [2, 3, 4]),
    "underlined forward": ("look\n\n________________________________\nFrom: a@b.example\nSent: now\n\nold", [3, 4, 5, 7]),
    "signed frame": ("-----BEGIN PGP SIGNED MESSAGE-----\nHash: MD5\n\nnew\n\n-----BEGIN PGP SIGNATURE-----\nVersion: 2.6\n\nabc\n-----END PGP SIGNATURE-----", [1, 2, 6, 7, 9, 10]),
    "key sent as content": ("here\n-----BEGIN PGP PUBLIC KEY BLOCK-----\nabc\n-----END PGP PUBLIC KEY BLOCK-----", []),
    "disclaimer": ("new\n\nThis message and any attachment are confidential and meant only for the\nperson addressed.", [3, 4]),
    "german notice": ("neu\n\nDiese Nachricht ist vertraulich.\nWeitergabe verboten.", [3, 4]),
    "footer": ("new\n\n_______________________________________________\nTo leave this list, mail the word remove to the list server", [3, 4]),
    "script": ("Try this:\n    tool -x 3\n    exit 0", []),
    "long unmarked": ("new words\n\nAnn Lee\nArchivist, Stone Ferry\n555-0100\n" + "\n".join(f"tel 555-01{i:02}" for i in range(12)), list(range(3, 18))),
    "wide unmarked": ("new words\n\nAnn Lee\n" + "x" * 70 + "@" + "y" * 40 + ".example", [3, 4]),
    "sentence with an address": ("new words\n\nOne more thing\nplease write to me at a@b.example whenever the machine is down again", []),
    "box of many lines": ("new\n\n" + "=" * 30 + "\n" + "\n".join(f"Ann Lee {i}" for i in range(12)) + "\n" + "=" * 30, list(range(3, 17))),
    "ruled prose": ("new\n\n" + "=" * 30 + "\nthis whole part is about the ruled words of mine\nand it goes on as a sentence of many words\n" + "=" * 30 + "\nmore", []),
    "own code": ("Here is the code:\n\n    for (i = 0; i < n; i++) {\n        total += price[i] * count[i];\n    }\n\nIt works.", []),
    "russian": ("Иван Петров писал(а):\n> старое\n\nновое", [1, 2]),
    "greek": ("Στις 3 Μαΐου ο Νίκος έγραψε:\n> παλιό\nνέο", [1, 2]),
    "chinese": ("在 1994-05-03，王明 写道：\n> 旧\n新", [1, 2]),
    "polish": ("Dnia 3 maja Anna Nowak napisała:\n> stare\nnowe", [1, 2]),
    "long attribution": ("On Mon, 3 May 1993, " + "Ann " * 60 + "wrote in her letter to all of us:\n> old\nnew", [1, 2]),
    "blank": ("\n \n\t\n", []),
}


@pytest.mark.parametrize("name", CASES)
def test_rules(name):
    body, lines = CASES[name]
    assert foreign(body) == lines


def test_frame_columns_and_corner_cases(spark):
    df = spark.createDataFrame([(1, None, "k"), (2, "", "k"), (3, "> a\nb\r\n", "k"), (3, "> a\nb\r\n", "k"), (4, "> x\n" * 100_000 + "y", "k")], "pos long, body string, kind string")
    rows = foreign_lines(df).collect()
    assert sorted((r.pos, r.line_no) for r in rows if r.pos == 3) == [(3, 1), (3, 1)]
    assert sum(r.pos == 4 for r in rows) == 100_000
    texts = {r.pos: r.own_text for r in own_texts(df).collect()}
    assert texts[1] is None and texts[2] == "" and texts[4] == "y"
    assert foreign_lines(df.limit(0)).count() == 0


@pytest.mark.parametrize("body", ["-" * 30 + "\n", "|x\n", "| a | b |\n", "    words of more than five here\n", "a:\n", "From: x\n", "On a b c d e,\n", "-" * 30 + "\nx\n" + "=" * 30 + "\ny\n", "# a b\n", "Ann wrote: "])
def test_lines_are_linear_in_length(body):
    import time

    def took(n):
        began = time.perf_counter()
        line_kinds(body * n)
        return time.perf_counter() - began

    took(100)
    assert min(took(20_000) for _ in range(2)) < 9 * min(took(5_000) for _ in range(3)) + 0.1
    assert len(line_kinds(body * 50_000)) == body.count("\n") * 50_000 + 1
