"""Secrets, personal data and boilerplate lines."""

import random
import re
import time
from collections import Counter

import duckdb
import pytest

from rillflow.llm import boilerplate, queries, secrets, surrogates

DOCS = "doc_id long, text string, source string, n_lines long"
KEY = "test key"


def table(spark, rows):
    return spark.createDataFrame([(d, t, s, -1) for d, t, s in rows], DOCS).repartition(3)


# Personal data

TEXTS = {
    1: "Write to Anna.Smith@mail.example.com or ANNA.SMITH@MAIL.EXAMPLE.COM, call +1 (017) 555-7713.",
    2: "Card 4539 5787 6362 1486 and 4539578763621486, host 10.20.30.40, not 999.1.2.3.",
    3: "Mr. Peter Miller met Mrs Clara Jones; Peter Miller left. Dr Watson too. Г-жа? г-жа Анна Петрова",
    4: "anna.smith@mail.example.com again, ssn 123-45-6789",
    5: "nothing to see, 2024-01-02 and 3.14 and 12 apples",
    6: None,
    7: "",
}


def replaced(spark, rows, key=KEY):
    return {r.doc_id: r for r in surrogates.replace_personal_data(table(spark, rows), key).collect()}


def test_types_formats_and_coreference(spark):
    got = replaced(spark, [(i, t, "s") for i, t in TEXTS.items()])
    assert got[5].text == TEXTS[5] and got[6].text is None and got[7].text == ""
    assert [got[i].n_replaced for i in range(1, 8)] == [3, 3, 5, 2, 0, 0, 0]
    lower, upper = re.findall(r"\S+@[\w.]+\w", got[1].text)
    assert upper == lower.upper() and lower in got[4].text
    assert "Smith" not in got[1].text and re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}\.", got[1].text)
    spaced, plain = re.search(r"Card (\d{4} \d{4} \d{4} \d{4}) and (\d{16}), host", got[2].text).groups()
    assert spaced.replace(" ", "") == plain != "4539578763621486" and surrogates._luhn(plain) == 0
    assert "10.20.30.40" not in got[2].text and "999.1.2.3" in got[2].text
    first, second, third = re.match(r"Mr. (\w+ \w+) met Mrs (\w+ \w+); (\w+ \w+) left", got[3].text).groups()
    assert first == third and first.split()[0] in surrogates.GIVEN["m", "latin"]
    assert second.split()[0] in surrogates.GIVEN["f", "latin"]
    given = re.search(r"г-жа (\w+) (\w+)$", got[3].text).groups()
    assert given[0] in surrogates.GIVEN["f", "cyrillic"] and surrogates.script_of(given[1]) == "cyrillic"


def test_what_stands_after_a_name(spark):
    texts = [
        "Mr Smith john@acme.com", "Contact Anna anna.smith@x.com now", "Watson was there. Dr Watson came, Watson left.",
        "Mr. Peter Miller and Mrs Clara Jones; Miller's book, JONES. Millers", "Mr von Anna Berg", "Mr john@acme.com",
    ]
    got = replaced(spark, [(i, t, "s") for i, t in enumerate(texts)])
    assert "john" not in got[0].text and "acme" not in got[0].text and "Smith" not in got[0].text
    assert "anna" not in got[1].text and "smith" not in got[1].text and got[1].text.endswith(" now")
    names = re.fullmatch(r"(\w+) was there. Dr (\w+) came, (\w+) left.", got[2].text).groups()
    assert len(set(names)) == 1 and names[0] != "Watson" and got[2].n_replaced == 3
    first, second, third, fourth = re.fullmatch(
        r"Mr. \w+ (\w+) and Mrs \w+ (\w+); (\w+)'s book, (\w+). Millers", got[3].text
    ).groups()
    assert first == third != "Miller" and second.upper() == fourth != "JONES"
    assert "Berg" not in got[4].text and got[5].text.endswith(".example")


def test_national_forms(spark):
    values = [
        "555-123-4567", "555.123.4567", "030 1234567", "030/1234567", "020 7946 0958", "01 23 45 67 89", "1-800-555-0199",
        "123 45 6789", "2001:db8:0:1::17", "fe80::1", "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000", "Michael Brown",
    ]
    kept = ["at 12:30:45 sharp", "on 01.02.2024 or 01-02-2024", "std::vector", "AB12 CDEF GHIJ KLMN", "1, 2 and 345"]
    rows = [(i, f"it is {v} AND so", "s") for i, v in enumerate(values)] + [(100 + i, t, "s") for i, t in enumerate(kept)]
    got = replaced(spark, rows)
    for i, v in enumerate(values):
        new = re.fullmatch("it is (.*) AND so", got[i].text).group(1)
        assert got[i].n_replaced == 1 and new != v and v not in new
        if i < 8:
            assert re.sub(r"\d", "0", new) == re.sub(r"\d", "0", v)
        if v[:2] in ("GB", "DE"):
            assert surrogates._iban_rest(new) == 1 and len(new) == len(v)
    assert [got[100 + i].text for i in range(len(kept))] == kept


def test_keyed_and_repeatable(spark):
    rows = [(i, t, "s") for i, t in TEXTS.items()]
    one, again, other = replaced(spark, rows), replaced(spark, rows[::-1]), replaced(spark, rows, "another")
    assert {k: r.text for k, r in one.items()} == {k: r.text for k, r in again.items()}
    assert one[2].text != other[2].text


def test_distinct_entities_get_distinct_surrogates(spark):
    """So few names that the first draws collide."""
    entities = [("name", "f/latin/2", f"Anna Miller{i}") for i in range(3000)] + [("phone", "", str(i)) for i in range(80, 100)]
    df = spark.createDataFrame(entities, "kind string, form string, value string")
    got = surrogates.distinct_surrogates(df, KEY, 60).collect()
    assert len(got) == len(entities) == len({(r.kind, r.surrogate) for r in got if r.kind == "name"}) + 20
    assert len({r.surrogate for r in got if r.kind == "phone"}) == 20
    assert not {r.surrogate for r in got if r.kind == "phone"} & {str(i) for i in range(80, 100)}


def test_repeated_rows_long_texts_and_empty_tables(spark):
    long = "word " * 40_000 + "x@y.example.org" + " word" * 10
    rows = [(1, "a@b.example.org", "s"), (1, "a@b.example.org", "s"), (1, "other c@d.example.org", "s"), (None, long, None)]
    got = surrogates.replace_personal_data(table(spark, rows), KEY)
    assert got.columns == ["doc_id", "text", "source", "n_replaced"] or "n_lines" in got.columns
    out = got.collect()
    assert len(out) == 4 and all(r.n_replaced == 1 for r in out)
    assert not any(v in r.text for r in out for v in ("a@b", "c@d", "x@y"))
    assert surrogates.replace_personal_data(table(spark, []), KEY).collect() == []


def test_no_value_of_the_documents_is_left(spark):
    sf = "/root/testdata/sf0.01"
    texts = dict(duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall())
    got = {r.doc_id: r for r in queries.op2_surrogates(spark, sf).collect()}
    assert set(got) == set(texts)
    hidden = re.compile(r"[\w.]+@mail\d\.example\.com|\+1 \(\d{3}\) 555-\d{4}|(?:\d{1,3}\.){3}\d{1,3}|\d{16}", re.I)
    for doc_id, text in texts.items():
        values = hidden.findall(text or "")
        assert all(v not in got[doc_id].text for v in values)
        assert bool(values) == (got[doc_id].text != text)


PEOPLE = [
    "Dr Zorb Kim and Mr Zorb Kim, Mrs Kim",
    "John Smith met Mr Smith. Dr Smith said so. Smith left. JOHN SMITH came, SMITH went.",
    "Mr Smith, then Sarah Smith, Mrs Smith, Ms Smith",
    "Anna-Lena Müller, Jean-Pierre Dupont and 'Lena Müller' with Mr Xu-Paul Berg",
    "+49 170 1234567, +1 (555) 123-4567, +423 234 5678, 491701234567",
    "+49 170 1234567x@left.example.org",
]


def test_a_person_has_one_surrogate(spark):
    got = replaced(spark, [(i, t, "s") for i, t in enumerate(PEOPLE)])
    doctor, mister, missis = re.match(r"Dr (\w+ \w+) and Mr (\w+ \w+), Mrs (\w+)$", got[0].text).groups()
    assert doctor == mister and doctor.split()[0] in surrogates.GIVEN["m", "latin"] and missis != doctor.split()[1]
    whole = re.match(r"(\w+ (\w+)) met Mr (\w+). Dr (\w+) said so. (\w+) left. (\w+ \w+) came, (\w+) went.$", got[1].text)
    name, family, *others, capitals, alone = whole.groups()
    assert set(others) == {family} and capitals == name.upper() and alone == family.upper()
    mr, sarah, *mrs = re.match(r"Mr (\w+), then \w+ (\w+), Mrs (\w+), Ms (\w+)$", got[2].text).groups()
    assert set(mrs) == {sarah} and mr != sarah
    assert not any(n in got[3].text for n in ("Anna-", "Müller", "Jean", "Pierre", "Dupont", "Paul", "Berg", "Xu"))
    first, second, third, plain = re.match(r"\+49 (.{11}), \+1 (.{14}), \+423 (.{8}), (\d{12})$", got[4].text).groups()
    assert plain.startswith("4917012") or plain == "49" + first.replace(" ", "")
    assert (first, second, third) != ("170 1234567", "(555) 123-4567", "234 5678")
    assert "left" not in got[5].text and "1234567" not in got[5].text


def plainly_replaced(texts, key):
    """The same by dictionaries: all entities at once, round by round."""
    found = {i: list(surrogates.mentions(t or "")) for i, t in texts.items()}
    forms = {}
    for places in found.values():
        for *_, kind, form, value in places:
            forms.setdefault((kind, value), set()).add(form)
    left = {}
    for (kind, value), told in forms.items():
        form = max(told)
        if kind == "name":
            genders = {f[0] for f in told} - {"n"}
            form = (genders.pop() if len(genders) == 1 else "n") + form[1:]
        left[kind, value] = form
    taken, chosen, attempt = set(forms), {}, 0
    while left:
        drawn = {}
        for (kind, value), form in sorted(left.items()):
            new = surrogates.surrogate(kind, form, value, key.encode(), attempt)
            drawn.setdefault((kind, new), value)
        won = {(kind, value): new for (kind, new), value in drawn.items() if (kind, new) not in taken}
        taken |= {(kind, new) for (kind, _), new in won.items()}
        chosen |= won
        left = {entity: form for entity, form in left.items() if entity not in won}
        attempt += 1
    result = {}
    for i, text in texts.items():
        for start, end, kind, _, value in reversed(found[i]):
            text = text[:start] + surrogates.written(kind, text[start:end], chosen[kind, value]) + text[end:]
        result[i] = text
    return result


def test_against_dictionaries(spark):
    texts = dict(duckdb.sql("select doc_id, text from '/root/testdata/sf0.01/documents.parquet'").fetchall())
    texts |= {-1 - i: t for i, t in enumerate([*PEOPLE, *TEXTS.values()])}
    texts |= {-1000 - i: f"Mr John Miller{'abcdefghij'[i % 10]}{'abcdefghij'[i // 10]} called" for i in range(100)}
    got = replaced(spark, [(i, t, "s") for i, t in texts.items()])
    assert {i: r.text for i, r in got.items()} == plainly_replaced(texts, KEY)


def test_a_type_without_any_value_left(spark):
    rows = [("phone", "", str(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "kind string, form string, value string")
    got = surrogates.distinct_surrogates(df, KEY, 2).collect()
    assert len({r.surrogate for r in got}) == 10 and all(re.fullmatch(r"\[phone-[0-9a-f]{32}\]", r.surrogate) for r in got)
    assert surrogates.written("phone", "5", got[0].surrogate) == got[0].surrogate


def test_long_runs_without_blanks_take_linear_time():
    for run in ("a" * 1_000_000, "Aa-" * 300_000, "a.b-" * 250_000):
        start = time.process_time()
        assert list(surrogates.mentions(run)) == []
        assert time.process_time() - start < 10  # a quadratic search takes minutes


# Secrets


def random_secret(rng, size=40):
    return "".join(rng.choice("0123456789abcdef") for _ in range(size))


def labelled(rng, n):
    rows = []
    for i in range(n):
        word = "".join(rng.choice(["the", "ing", "and", "ent", "ion"]) for _ in range(5))
        rows.append((random_secret(rng), 'token = "', "app/settings.py", 1))
        rows.append((f"{word}{i % 10}", "see the page ", "docs/page.md", 0))
        rows.append((str(rng.randrange(10**15, 10**16)), "number ", "docs/page.md", 0))
    return rows


def test_forest_on_held_out_findings(spark):
    rng = random.Random(4)
    schema = "value string, before string, path string, label int"
    letters = secrets.Letters(["the king and the entering nation handing ending"] * 5)
    model = secrets.train(spark.createDataFrame(labelled(rng, 150), schema), letters)
    test = spark.createDataFrame(labelled(rng, 100), schema)
    got = secrets.score(test, model, letters).collect()
    right = sum((r.probability > 0.5) == (r.label == 1) for r in got)
    assert len(got) == 300 and right >= 0.95 * len(got)


def test_features_are_named():
    letters = secrets.Letters(["password examples"])
    assert len(secrets.features("abc123def456", "my token = '", "src/a.py", letters)) == len(secrets.FEATURES)
    assert letters.coverage("xpasswordx1") == (8 / 11, 8)


def test_candidates_and_edges(spark):
    value = random_secret(random.Random(1))
    rows = [(1, f'token = "{value}" end', "a"), (2, None, None), (3, "", "b"), (4, "plain words only" * 999, None)]
    rows += [(5, f"x {value}", "a"), (5, f"x {value}", "a")]
    got = sorted((r.doc_id, r.start, r.end, r.before) for r in secrets.candidates(table(spark, rows)).collect())
    assert got == [(1, 9, 49, 'token = "'), (5, 2, 42, "x "), (5, 2, 42, "x ")]
    long = random_secret(random.Random(2), 5000)
    rows_of = [(6, f"a.key={value}", "a"), (7, long + "==", "a"), (8, f"conf.{value}", "a")]
    got = sorted((r.doc_id, r.start, r.end) for r in secrets.candidates(table(spark, rows_of)).collect())
    assert got == [(6, 6, 46), (7, 0, 5002), (8, 5, 45)]
    assert secrets.scan(table(spark, [])).collect() == []
    assert len(secrets.scan(table(spark, rows)).collect()) == 3


def test_secrets_of_the_documents(spark):
    sf = "/root/testdata/sf0.01"
    texts = dict(duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall())
    planted = Counter()
    for doc_id, text in texts.items():
        for found in re.finditer(r'(?i)(?:token = "|password=)([0-9a-f]{18,40})\b|\b(AKIA[0-9A-Z]{16})\b', text or ""):
            planted[doc_id, *found.span(found.lastindex)] += 1
    got = Counter((r.doc_id, r.start, r.end) for r in queries.op1_secret_scan(spark, sf).collect() if r.is_secret)
    assert got == planted


WRITTEN = [
    ('password = "hunter2!"', "hunter2!"), ("password=Tr0ub4dor&3", "Tr0ub4dor&3"),
    ('db_password = "S3cr3t#Passw0rd!"', "S3cr3t#Passw0rd!"), ("see postgres://u:p4ssw0rd@h/db", "p4ssw0rd"),
    ("passphrase: 'correct horse battery staple'", "correct horse battery staple"), ("auth: token=short,", "short"),
    ('{"api_key" : "a\\"b"}', 'a\\"b'), ("Authorization: Bearer abc.def", "abc.def"), ('secret = "open', "open"),
]
PLAIN_KEYS = [
    "sk_live_" + "4eC39HqLyjWDarjtT1zdp7dc", "glpat-" + "ABCdefGHIjklMNOpqrst", "npm_" + "aB3" * 12,
    "SG." + "Ab1-" * 6 + "." + "xY9_" * 10, "eyJhbGciOiJIUzI1NiJ9." + "eyJzdWIiOiIxMjM0NTY3ODkwIn0" + ".dozjgNryP4J3jVmN",
]


def test_values_of_any_form_are_candidates(spark):
    rows = [(i, text, "a") for i, (text, _) in enumerate(WRITTEN)] + [(100 + i, f"use {k} now", "a") for i, k in enumerate(PLAIN_KEYS)]
    found = secrets.candidates(table(spark, rows)).withColumn("label", secrets.rule_label()).collect()
    got = {(r.doc_id, r.value): r.label for r in found}
    assert all((i, value) in got for i, (_, value) in enumerate(WRITTEN))
    assert [got[i, WRITTEN[i][1]] for i in range(4)] == [1] * 4
    assert [got.get((100 + i, k)) for i, k in enumerate(PLAIN_KEYS)] == [1] * len(PLAIN_KEYS)
    assert {r.after for r in found if r.doc_id == 100} == {" now"}
    assert all(text[r.start : r.end] == r.value for r in found for i, text, _ in rows if i == r.doc_id)


def test_long_chains_of_assignments():
    found = list(secrets.findings_of("key=" * 50_000 + "x"))
    assert len(found) <= 3 and max(len(r[2]) for r in found) == 4 * 49_999 + 1


def test_short_secrets_are_told_from_references(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghkmnoprstuvw") for _ in range(rng.randrange(4, 9)))
    rows = []
    for i in range(150):
        rows.append((i, f'the {word()} line\npassword = "{word().title()}{rng.randrange(10, 99)}!"\n', "app/a.py"))
        rows.append((200 + i, f"page {word()}-{word()}-{rng.randrange(100)}\npassword = your_{word()}\n", "app/b.py"))
    rows.append((999, 'password = "hunter2!"', "app/a.py"))
    got = [r for r in secrets.scan(table(spark, rows)).collect()]
    assert any(r.doc_id == 999 and r.is_secret for r in got)
    assert sum(r.is_secret for r in got if r.doc_id < 150) >= 145
    assert sum(r.is_secret for r in got if 200 <= r.doc_id < 350) <= 5


def test_letters_count_every_word_of_every_text(spark):
    rng = random.Random(12)
    words = sorted({"".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(4, 15))) for _ in range(24_000)})
    texts = [(i, "filling " * 600 + " ".join(words[i::800] * 3), "s") for i in range(800)]  # behind 4,000 characters
    texts += [(900, "once", "s"), (901, None, "s"), (902, "", "s")]
    letters = secrets.letters_of(table(spark, texts))
    pieces = {r.piece: r.weight for r in letters.collect()}
    local = secrets.Letters([t for _, t, _ in texts if t])
    assert {p for p in pieces if len(p) > 2} == {*words, "filling"} and "once" in local.words
    assert {p: round(w, 9) for p, w in pieces.items() if len(p) == 2} == {p: round(w, 9) for p, w in local.steps.items()}
    values = [(f"{words[i]}-{words[-i]}-2024", "see ", "a.md") for i in range(1, 300)] + [("x1!Ж" * 900, "", "")]
    found = spark.createDataFrame(values * 2, "value string, before string, path string")
    got = sorted((r.value, [round(x, 9) for x in r.features]) for r in secrets.with_features(found, letters).collect())
    assert got == sorted((v, [round(x, 9) for x in secrets.features(v, b, p, local)]) for v, b, p in values * 2)
    at = secrets.FEATURES.index("dictionary")
    assert all(f[at] > 0.5 for v, f in got if v.endswith("2024"))
    assert secrets.letters_of(table(spark, [])).collect() == []


# Lines


def slow_lines(rows, ratio, least):
    pages, lines = Counter(), Counter()
    for _, text, host in rows:
        if host is not None:
            pages[host] += 1
            lines.update({(host, k) for k in {x.strip(" \t\r") for x in (text or "").split("\n")} if k})
    out = []
    for doc_id, text, host in rows:
        if text is None:
            out.append((doc_id, None, 0, 0))
            continue
        split = text.split("\n")
        kept = [
            x for x in split
            if not x.strip(" \t\r") or host is None or (n := lines[host, x.strip(" \t\r")]) < least or n <= ratio * pages[host]
        ]
        out.append((doc_id, "\n".join(kept), len(split), len(split) - len(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("ratio", [0.05, 0.3])
def test_lines_against_counting(spark, ratio):
    rng = random.Random(6)
    rows = []
    for i in range(400):
        lines = [rng.choice(["menu", " menu\t", "© all", "", "  ", f"line {rng.randrange(60)}", f"own {i}"]) for _ in range(6)]
        rows.append((i, "\n".join(lines), rng.choice(["a", "a", "a", "b", "c", None])))
    rows += [(900, None, "a"), (901, "", "b"), (902, "menu", "a"), (902, "menu", "a"), (None, "menu\n", "a"), (903, "menu", "new")]
    rows += [(904, "menu\n" * 20_000 + "end", "a")]
    got = boilerplate.drop_boilerplate(table(spark, rows), ratio=ratio)
    assert got.columns == ["doc_id", "text", "source", "n_lines", "n_dropped"]
    assert sorted((tuple(r) for r in got.drop("source").collect()), key=repr) == slow_lines(rows, ratio, 5)


def test_no_pages(spark):
    assert boilerplate.drop_boilerplate(table(spark, [])).collect() == []
