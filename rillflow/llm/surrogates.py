"""Personal data in texts replaced by keyed surrogates of the same type and form."""

from __future__ import annotations

import bisect
import hmac
import ipaddress
import re
from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillflow.llm.running import same
from rillflow.session import materialize

#: Given names by gender and script, of which surrogates are drawn and by which names are told.
GIVEN = {
    ("f", "latin"): "Anna Maria Laura Sarah Emma Julia Clara Elena Sofia Marta Lucia Nora Alice Ines Eva Lena".split(),
    ("m", "latin"): "John Peter Paul Thomas David Martin Daniel Marco Lucas Simon Hugo Felix Oscar Emil Leon Karl".split(),
    ("f", "cyrillic"): "Анна Мария Елена Ольга Ирина Наталья Вера Дарья".split(),
    ("m", "cyrillic"): "Иван Пётр Сергей Павел Андрей Николай Олег Борис".split(),
}
#: Titles before a name and the gender they tell.
TITLES = {
    "Mr": "m", "Mister": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "г-н": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Señora": "f", "Sra": "f", "г-жа": "f",
    "Dr": "n", "Prof": "n",
}
#: More given names by which names are told (fixed values); names that are common words are left out.
KNOWN = {
    "f": """Abigail Adriana Agnes Alexandra Alexis Alicia Alina Alison Allison Amanda Amber Amelia Amy Ana Andrea Angela Anita Anne Annette
        Antonia Aisha Ashley Barbara Beatrice Beatriz Bella Bernadette Betty Beth Birgit Brenda Bridget Brigitte Camila Camille Carla Carmen Carol
        Carolina Caroline Catherine Cecilia Charlotte Chloe Christina Christine Claudia Colette Cristina Cynthia Daniela Deborah Debra Denise Diana
        Diane Dolores Donna Dorothy Edith Eleanor Elisabeth Elizabeth Ella Ellen Emily Erika Esther Eva Evelyn Fatima Fiona Florence Frances
        Francesca Franziska Gabriela Gabriele Geraldine Giulia Gloria Greta Hanna Hannah Heather Heidi Helen Helena Helga Ingrid Irene Isabel Isabella
        Isabelle Jacqueline Jane Janet Janice Jean Jennifer Jessica Joan Joanna Johanna Josephine Joyce Juana Judith Judy Juliette Karen Karin Katharina
        Katherine Kathleen Katja Kelly Kimberly Kristin Larissa Lauren Leah Leila Linda Lisa Louise Luisa Lydia Madison Manon Margaret Margarita
        Marie Marion Marlene Martha Martina Mary Megan Melanie Melissa Mia Michelle Mila Mildred Miriam Monica Monika Nadia Nancy Natalia Natalie Nicole
        Nina Olga Olivia Pamela Patricia Paula Petra Pilar Priya Rachel Raquel Rebecca Renate Rita Roberta Rosa Ruth Sabine Samantha Sandra Shirley Silvia
        Simone Sonia Sophia Sophie Stefanie Stephanie Susan Susanne Sylvia Tamara Tatiana Teresa Theresa Ursula Valentina Valeria Vanessa Vera Veronica
        Victoria Virginia Vivian Wendy Yasmin Yolanda Yvonne Zoe Александра Алина Анастасия Валентина Галина Екатерина Ксения Людмила Надежда Светлана Татьяна Юлия""",
    "m": """Aaron Adam Adrian Ahmed Alan Albert Alberto Alejandro Alessandro Alexander Alfred Ali Anders Andre Andreas Andrew Angelo Anthony Antoine
        Antonio Arthur Barry Benjamin Bernard Bernd Brandon Brian Bruce Bryan Carl Carlos Charles Christian Christoph Christopher Claude Craig Dennis Diego
        Dieter Dominik Donald Douglas Dylan Edgar Eduardo Edward Edwin Enrique Eric Erik Ernst Ethan Eugene Fabian Federico Fernando Florian Francesco
        Francis Francisco Franz Frederick Fritz Gabriel Gary Georg George Gerald Gerard Gerhard Giovanni Giuseppe Gregory Guillaume Gustav Hans Harold Harry
        Heinrich Helmut Henri Henry Herbert Hermann Howard Ian Ibrahim Ignacio Ivan Jack Jacob Jacques Jakob James Jan Jason Javier Jeffrey Jeremy Jerry Jesse
        Joachim Joe Joel Jonas Jonathan Jorge Jose Josef Joseph Joshua Juan Juergen Julian Julien Justin Keith Kenneth Kevin Klaus Konrad Kurt Kyle Larry
        Lars Laurent Lawrence Louis Luca Luigi Luis Lukas Manuel Marc Marcel Marcus Mario Markus Matteo Matthew Matthias Max Maximilian Michael Michel Miguel
        Mohammed Muhammad Nathan Nicholas Nicolas Niklas Noah Olaf Oliver Olivier Otto Pablo Pascal Patrick Pedro Philip Philipp Philippe Pierre Rafael Ralph
        Raymond Ricardo Richard Robert Roberto Rodrigo Roger Roland Ronald Rudolf Russell Ryan Salvatore Samuel Scott Sean Sebastian Sergio Stefan Stephen
        Steven Sven Theodor Thierry Tim Timothy Tobias Tom Tyler Uwe Victor Vincent Vincenzo Walter Wayne Werner William Wolfgang Xavier Yannick Zachary
        Александр Алексей Анатолий Василий Виктор Владимир Дмитрий Евгений Михаил Роман Юрий""",
}
_GENDER_OF = {name: gender for gender, names in KNOWN.items() for name in names.split()}
_GENDER_OF |= {name: key[0] for key, names in GIVEN.items() for name in names}

#: Country calling codes of one and two digits (fixed values); all others have three.
SHORT_CODES = (
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66"
    " 81 82 84 86 90 91 92 93 94 95 98"
).split()

_NAME = r"[^\W\d_]+(?:[-'’][^\W\d_]+)*"
#: The next word of a name: none that begins an address.
_NEXT = rf"[ ]+(?![\w.%+'’-]*@){_NAME}"
_MAIL = r"[\w.%+-]++@[\w-]+(?:\.[\w-]+)+"
#: The types in the order in which they claim text; letter case is of no matter but in names.
PATTERNS = {
    "email": rf"(?<![\w.%+-]){_MAIL}",
    "ip": r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w.]*\d)",
    "ip6": r"(?<![\w:.])(?=[0-9A-Fa-f]{0,4}:[0-9A-Fa-f]{0,4}:)[0-9A-Fa-f:]{2,38}[0-9A-Fa-f](?!\w)",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?!\w)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])|(?<![\w.-])(?<!\d )\d{3} \d{2} \d{4}(?![\w-]| \d)",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3}[ .-]?\d{3,4}(?!\d)|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\d)"
    r"|(?<![\w.+/-])(?<!\d )(?:1[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}(?![ .-]?\d|\w)"
    r"|(?<![\w.+/-])(?<!\d )0\d{1,4}[ /-]\d{5,8}(?![ .-]?\d|\w)"
    r"|(?<![\w.+/-])(?<!\d )(?=0(?:[ ./-]?\d){8,11}(?!\d))0\d{1,4}(?:[ ./-]\d{2,4}){2,4}(?![ .-]?\d|\w)",
    "card": r"(?<![\w.])\d(?:[ -]?\d){12,18}(?![\w])",
    "name": rf"(?<!\w)(?=[A-ZА-Яг])(?:(?:{'|'.join(TITLES)})\.?{_NEXT}(?:{_NEXT})?"
    rf"|(?<!\w[-'’])(?:[^\W\d_]++[-'’])*(?:{'|'.join(_GENDER_OF)})(?:[-'’][^\W\d_]+)*{_NEXT})",
}
#: An address that begins where another entity ended.
_MAIL_HERE = re.compile(_MAIL)
_ALL = re.compile("|".join(f"(?P<{kind}>{pattern})" for kind, pattern in PATTERNS.items()))
#: What any match holds; the engine's regex picks the documents to be looked at by it.
HINT = (
    r"@|\d(?:[.\-)]\d|\d{6}|[ -]\d[ -]?\d|/\d{2})|\+\d|\)[ .-]?\d|:[0-9A-Fa-f]{0,4}:|[A-Z]{2}\d{2} ?[A-Z0-9]{4}"
    r"|(?=[A-ZА-Яг])(?<!\w)(?:" + "|".join([*TITLES, *_GENDER_OF]) + ")"
)


def script_of(text: str) -> str:
    return "cyrillic" if any("Ѐ" <= c <= "ӿ" for c in text) else "latin"


def mentions(text: str) -> Iterator[tuple[int, int, str, str, str]]:
    """Start, end, type, form and value of each entity. Equal values are one entity.

    The value is what identifies the entity: a card without blanks, an address in
    lower case, a name without its title. The form is what a surrogate must match.
    A surname after a title or alone is the person of that name, of a gender the
    title allows, who is named in full last before it, or else first after it. A full name
    that the text also has in capitals is the same person.
    """
    found = list(_direct(text))
    told: dict[str, set[str]] = {}
    for *_, kind, form, value in found:
        if kind == "name":
            told.setdefault(value, set()).add(form[0])
    full: dict[str, list[tuple[int, str, str]]] = {}
    for start, _, kind, form, value in found:
        if kind == "name" and " " in value:
            known = told[value] - {"n"}
            form = (known.pop() if len(known) == 1 else "n") + form[1:]
            full.setdefault(value.split()[-1].upper(), []).append((start, form, value))
    people: dict[str, list[tuple[int, str, str]]] = {}
    for n, (start, end, kind, form, value) in enumerate(found):
        if kind != "name" or len(surname := value.split()[-1]) < 2:
            continue
        if " " not in value and (named := full.get(surname.upper())):
            named = [p for p in named if p[1][0] == form[0] or "n" in (p[1][0], form[0])]
            if named:
                form, value = named[max(bisect.bisect(named, (start,)) - 1, 0)][1:]
                found[n] = (start, end, kind, form, value)
        people.setdefault(surname.upper(), []).append((start, form, value))
        if " " in value:
            people.setdefault(value.upper(), []).append((start, form, value))
    if people:
        spelled = {n for k, named in people.items() for n in (k, named[0][2].split()[-1])}
        either = "|".join(re.escape(n) for n in sorted(spelled, key=lambda n: (-len(n), n)))
        at = 0
        for bare in re.finditer(rf"(?<!\w)(?:{either})(?!\w)", text):
            while at < len(found) and found[at][1] <= bare.start():
                yield found[at]
                at += 1
            if at < len(found) and found[at][0] < bare.end():
                continue
            named = people[bare.group().upper()]
            nth = max(bisect.bisect(named, (bare.start(),)) - 1, 0)
            yield bare.start(), bare.end(), "name", *named[nth][1:]
        yield from found[at:]
    else:
        yield from found


def _direct(text: str) -> Iterator[tuple[int, int, str, str, str]]:
    """The mentions that :data:`PATTERNS` find; after a match that is cut or left out the search goes on inside it."""
    after = 0
    while found := (after and _MAIL_HERE.match(text, after)) or _ALL.search(text, after):
        kind, start, end = found.lastgroup or "email", found.start(), found.end()
        after = end
        if kind == "ip" and any(int(part) > 255 for part in found.group().split(".")):
            continue
        if kind == "ip6":
            try:
                yield start, end, kind, "", str(ipaddress.IPv6Address(found.group()))
            except ValueError:
                after = start + 1  # a time of day or the like
        elif kind == "iban":
            whole = found.group()
            ends = [n for n in range(len(whole), 14, -1) if n == len(whole) or not whole[n].isalnum()]
            good = next((n for n in ends if whole[n - 1].isalnum() and _iban_rest(whole[:n]) == 1), None)
            after = start + (good or 2)
            if good:
                yield start, after, kind, "", re.sub(r"[ ]", "", whole[:good])
        elif kind == "name":
            first, _, rest = found.group().partition(" ")
            title = first.rstrip(".")
            if title in TITLES:
                start = end - len(rest.lstrip())
            words = text[start:end].split()
            if title in TITLES and not words[-1][:1].isupper():
                end = start + len(words[0])  # "Dr Watson too": the second word is none of the name
            name = text[start:end]
            after = end
            if not all(part[:1].isupper() for part in name.split()):
                after = found.start() + len(first)
                continue
            given = name.split()[0]
            told = (_GENDER_OF[part] for part in [given, *re.split("[-'’]", given)] if part in _GENDER_OF)
            gender = next(told, None) or TITLES.get(title, "n")
            yield start, end, kind, f"{gender}/{script_of(name)}/{len(name.split())}", " ".join(name.split())
        elif kind == "email":
            yield start, end, kind, "", found.group().lower()
        elif kind == "phone":
            yield start, end, kind, "+" if text[start] == "+" else "", re.sub(r"\D", "", found.group())
        else:
            yield start, end, kind, "", re.sub(r"\D" if kind != "ip" else r"[^\d.]", "", found.group())


class _Stream:
    """Numbers fixed by key, entity and attempt."""

    def __init__(self, key: bytes, *parts: str):
        self.key, self.name, self.used, self.left = key, "\0".join(parts).encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 4:
            self.left = hmac.new(self.key, self.name + self.used.to_bytes(4, "big"), sha256).digest()
            self.used += 1
        part, self.left = self.left[:4], self.left[4:]
        return int.from_bytes(part, "big") % n


def _luhn(digits: str) -> int:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if place % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10


def _iban_rest(text: str) -> int:
    """The number of an IBAN modulo 97; 1 if its check digits are right."""
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97


_SYLLABLES = {
    "latin": "ba be da do fa ga ka la le lo ma mi na no pa ra ri ro sa ta to va vi za".split(),
    "cyrillic": "ба бе да до га ка ла ле ло ма ми на но па ра ри ро са та то ва ви за".split(),
}


def surrogate(kind: str, form: str, value: str, key: bytes, attempt: int) -> str:
    """A value of the same type, script, gender, length of digits, country code; Luhn-valid where the value is."""
    draw = _Stream(key, kind, value, str(attempt))

    def word(script: str, least: int) -> str:
        some = _SYLLABLES[script]
        return "".join(some[draw.below(len(some))] for _ in range(least))

    if kind == "email":
        return f"{word('latin', 3 + attempt)}.{draw.below(10**6)}@{word('latin', 3)}.example"
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4))
    if kind == "ip6":  # of the range for examples
        return str(ipaddress.IPv6Address((0x20010DB8 << 96) + sum(draw.below(1 << 16) << 16 * n for n in range(6))))
    if kind == "iban":
        body = "".join(str(draw.below(10)) if c.isdigit() else chr(65 + draw.below(26)) for c in value[4:])
        return f"{value[:2]}{98 - _iban_rest(value[:2] + '00' + body):02d}{body}"
    if kind == "name":
        gender, script, parts = form.split("/")
        if gender == "n":
            gender = "fm"[draw.below(2)]
        names = GIVEN[gender, script]
        given = names[draw.below(len(names))]
        family = word(script, 3 + min(attempt, 3)).capitalize()
        return family if parts == "1" else f"{given} {family}"
    keep = 1 if kind == "phone" and len(value) > 10 else 0
    if form == "+":
        keep = next((n for n in (1, 2) if value[:n] in SHORT_CODES), 3)
    digits = value[:keep] + "".join(str(draw.below(10)) for _ in value[keep:])
    if kind == "card" and _luhn(value) == 0:
        digits = next(digits[:-1] + str(d) for d in range(10) if _luhn(digits[:-1] + str(d)) == 0)
    return digits


def written(kind: str, original: str, new: str) -> str:
    """The surrogate in the format of the text: blanks, hyphens, brackets and capitals stay, a surname alone is one."""
    if new.startswith("["):  # no surrogate was left
        return new
    if kind == "name" and " " not in original:
        new = new.split()[-1]
    if kind in ("email", "ip", "ip6", "name"):
        return new.upper() if not kind.startswith("ip") and original.isupper() else new
    if kind == "iban":
        signs = iter(new)
        return re.sub(r"[A-Z0-9]", lambda _: next(signs), original)
    digits = iter(new)
    return re.sub(r"\d", lambda _: next(digits), original)


FOUND = "doc long, hash long, start int, end int, kind string, form string, value string, original string"


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc", "hash", "start", "end", "kind", "form", "value", "original"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), *[pa.string()] * 4]
    for batch in batches:
        rows = []
        for doc, digest, text in zip(*(batch.column(c).to_pylist() for c in ("doc", "hash", "text"))):
            for start, end, kind, form, value in mentions(text):
                rows.append((doc, digest, start, end, kind, form, value, text[start:end]))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def settled(found: DataFrame) -> DataFrame:
    """``kind, value, form``: each entity once, with the form that all its mentions tell.

    A name is of the gender that a mention tells, unless another tells the other one;
    a number has a country code if it is written with one anywhere.
    """
    tells = {g: F.max((F.col("kind") == "name") & F.col("form").startswith(g)) for g in "fm"}
    entities = found.groupBy("kind", "value").agg(
        F.max("form").alias("form"), tells["f"].alias("_f"), tells["m"].alias("_m")
    )
    gender = F.when(F.col("_f") == F.col("_m"), "n").when(F.col("_f"), "f").otherwise("m")
    form = F.when(F.col("kind") == "name", F.concat(gender, F.substring("form", 2, 1000))).otherwise(F.col("form"))
    return entities.select("kind", "value", form.alias("form"))


def distinct_surrogates(entities: DataFrame, key: str, max_attempts: int = 20) -> DataFrame:
    """``kind, value, form`` with a ``surrogate`` that no other entity has, nor is one of the values.

    Every round draws surrogates for the entities still without; of those that drew
    the same, the least value keeps it. What is taken in a round stays taken. Whether
    a surrogate is itself a value in the texts is checked against all entities. Should
    the values of a type be so many that ``max_attempts`` rounds leave some without,
    those get their type and a keyed digest in square brackets.
    """
    secret = key.encode()

    def drawn(attempt: int):
        @F.pandas_udf("string")
        def draw(kind: pd.Series, form: pd.Series, value: pd.Series) -> pd.Series:
            return pd.Series([surrogate(k, f, v, secret, attempt) for k, f, v in zip(kind, form, value)])

        return draw

    spoken = entities.select(F.col("kind").alias("_kind"), F.col("value").alias("_value")).distinct()
    left, done = entities, None
    for attempt in range(max_attempts):
        tried = left.withColumn("surrogate", drawn(attempt)("kind", "form", "value"))
        taken = spoken if done is None else spoken.unionByName(
            done.select(F.col("kind").alias("_kind"), F.col("surrogate").alias("_value"))
        )
        clash = (F.col("kind") == F.col("_kind")) & (F.col("surrogate") == F.col("_value"))
        first = Window.partitionBy("kind", "surrogate").orderBy("value")
        tried = tried.withColumn("_nth", F.row_number().over(first)).join(
            taken.distinct().withColumn("_taken", F.lit(True)), clash, "left"
        )
        tried = materialize(tried.drop("_kind", "_value"), "surrogates-tried")
        good = (F.col("_nth") == 1) & F.col("_taken").isNull()
        won = tried.filter(good).drop("_nth", "_taken")
        done = won if done is None else done.unionByName(won)
        left = tried.filter(~good).drop("_nth", "_taken", "surrogate")
        if left.isEmpty():
            return done
    digest = F.sha2(F.concat_ws("\0", F.lit(key), "kind", "value"), 256)
    rest = left.withColumn("surrogate", F.concat(F.lit("["), "kind", F.lit("-"), F.substring(digest, 1, 32), F.lit("]")))
    return rest if done is None else done.unionByName(rest)


def replace_personal_data(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, personal data in ``text`` replaced; adds ``n_replaced``.

    Addresses, IP numbers, phone, social security and card numbers and names are
    found by :data:`PATTERNS`. An entity, that is a value of a type, gets the same surrogate
    wherever it stands and no two entities share one; see :func:`distinct_surrogates`. Surrogates
    depend on the key and the set of entities alone. Documents without a hint of
    an entity go through as they are; the others meet their replacements by doc_id
    and a hash of the text. Null and empty texts stay; rows that repeat get the
    same replacements. A column ``n_replaced`` that is there is replaced.
    """
    rows = docs.select(
        F.struct("*").alias("_row"),
        F.col("doc_id").cast("long").alias("doc"),
        F.xxhash64(text).alias("hash"),
        F.col(text).cast("string").alias("text"),
        F.coalesce(F.col(text).rlike(HINT), F.lit(False)).alias("_hint"),
    )
    found = materialize(
        rows.filter("_hint").select("doc", "hash", "text").mapInArrow(_find, FOUND), "personal-found"
    )
    entities = materialize(settled(found), "personal-entities")
    chosen = distinct_surrogates(entities, key).select(F.col("kind").alias("_kind"), F.col("value").alias("_value"), "surrogate")
    equal = [F.col(c) == F.col(f"_{c}") for c in ("kind", "value")]
    by_document = (
        found.join(chosen, equal[0] & equal[1])
        .groupBy(F.col("doc").alias("_doc"), F.col("hash").alias("_hash"))
        .agg(F.array_sort(F.collect_set(F.struct("start", "end", "kind", "original", "surrogate"))).alias("_found"))
    )

    @F.pandas_udf("string")
    def rewritten(texts: pd.Series, lists: pd.Series) -> pd.Series:
        out = []
        for body, places in zip(texts, lists):
            parts, at = [], 0
            for place in places if places is not None else ():
                parts += [body[at : place["start"]], written(place["kind"], place["original"], place["surrogate"])]
                at = place["end"]
            out.append(body if not at else "".join(parts) + body[at:])
        return pd.Series(out, dtype=object)

    def result(df: DataFrame, new_text, n) -> DataFrame:
        columns = [c for c in docs.columns if c != "n_replaced"]
        return df.select(
            *(new_text.alias(c) if c == text else F.col("_row").getField(c).alias(c) for c in columns),
            n.cast("long").alias("n_replaced"),
        )

    hinted = rows.filter("_hint").join(
        by_document, same(F.col("doc"), F.col("_doc")) & (F.col("hash") == F.col("_hash")), "left"
    )
    changed = result(
        hinted, rewritten("text", "_found"), F.greatest(F.coalesce(F.size("_found"), F.lit(0)), F.lit(0))
    )
    return changed.unionByName(result(rows.filter("not _hint"), F.col("text"), F.lit(0)))
