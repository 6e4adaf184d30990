"""Secrets in texts: candidates by pattern, false positives removed by a random forest."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.llm.running import least_hashed
from rillflow.llm.text import texts_of
from rillflow.session import materialize

#: A run of the characters of keys and tokens with a digit in it, of any length, or a private key's header.
#: "=" belongs to it at the end only (padding); before that it assigns.
CANDIDATE = re.compile(
    r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----|(?<![A-Za-z0-9_/+\-])(?=[A-Za-z_/+\-]*[0-9])[A-Za-z0-9_/+\-]{12,}={0,2}(?![A-Za-z0-9_/+\-])"
)
#: Published forms of keys that need no name before them (fixed values): cloud and hosting keys, payment, mail,
#: chat, map and model keys, packages, signed web tokens.
PUBLISHED = (
    r"(?:AKIA|ASIA)[0-9A-Z]{16}(?![0-9A-Z])|gh[pousr]_[0-9A-Za-z]{36,}|github_pat_\w{36,}|glpat-[\w-]{20,}|npm_[0-9A-Za-z]{36,}"
    r"|pypi-[\w-]{50,}|(?:sk|rk)_(?:live|test)_[0-9A-Za-z]{10,}|sk-[\w-]{20,}|SG\.[\w-]{16,}\.[\w-]{16,}|xox[abeprs]-[0-9A-Za-z-]{10,}"
    r"|AIza[\w-]{35}|ya29\.[\w-]{20,}|hf_[0-9A-Za-z]{30,}|shp(?:at|ca|pa|ss)_[0-9a-f]{32}|dop_v1_[0-9a-f]{64}"
    r"|eyJ[\w-]{10,}\.eyJ[\w-]{10,}(?:\.[\w-]*)?"
)
FORMED = re.compile(PUBLISHED, re.ASCII)
FORMS = rf"^({PUBLISHED}|-----BEGIN .*)$"
#: What assigns a value, the name of a secret before it, and the value: in quotes, or up to a blank.
SIGN = re.compile(r"[=:]|[Bb][Ee][Aa][Rr][Ee][Rr](?=[ \t])")
NAMED = re.compile(
    r"(?i)(?:token|secret|passw(?:or)?d|passphrase|pwd|pass|key|auth|credential|private|access|bearer)[\w-]{0,40}[\"']?[ \t]{0,8}$"
)
GAP = re.compile(r"=?>?[ \t]{0,8}")
QUOTED = {q: re.compile(rf"{q}(?:[^{q}\\\n]|\\.)+{q}") for q in "\"'"}
PLAIN = re.compile(r"[^\s\"',;]*")
#: The password of a URL.
IN_URL = re.compile(r"://[^\s:/@\"'<>]*:([^\s/\"'<>]+)@")
#: The same for the engine's regex, to pick documents.
HINT = r"[A-Za-z0-9_/+-]{12}|[=:]|-----BEGIN |[Bb][Ee][Aa][Rr][Ee][Rr][ \t]"
WORD = re.compile(r"[^\W\d_]+")
NO_WORD = re.compile(r"[\W\d_]")
#: Letters of the words that are looked for inside a value (fixed values).
SHORTEST, LONGEST = 4, 14
#: What a step counts as that stands in no word.
RARE = math.log(1 / 1000)
#: Words that name a secret when they stand before it, and placeholders that are none (fixed values).
NAMING = frozenset("token secret password passwd pwd apikey key auth bearer credential credentials private access".split())
DUMMY = re.compile(r"(?i)example|placeholder|changeme|dummy|sample|your|xxxx|0{6}|1234567|abcdef(?!0|\d)|(.)\1{5}")

FEATURES = (
    "length", "digits", "upper", "hex", "distinct", "entropy", "case_turns", "kind_turns", "transition",
    "dictionary", "longest_word", "assigned", "quoted", "named", "named_near", "words_before", "path_parts",
    "path_test", "path_code", "dummy", "named_after", "words_after",
)


class Letters:
    """How usual the steps from letter to letter are in words, and which words are known.

    Of a few ``texts`` all words are known. For whole tables see :func:`letters_of`.
    """

    def __init__(self, texts: list[str] = (), words: frozenset[str] = frozenset(), steps: dict[str, float] | None = None):
        if steps is not None:
            self.words, self.steps = words, steps
            return
        counts = Counter(word for text in texts for word in WORD.findall(text.lower()))
        pairs, firsts = Counter(), Counter()
        for word, n in counts.items():
            for a, b in zip(word, word[1:]):
                pairs[a + b] += n
                firsts[a] += n
        self.words = frozenset(word for word in counts if len(word) >= SHORTEST)
        self.steps = {step: math.log((n + 1) / (firsts[step[0]] + 40)) for step, n in pairs.items()}

    def transition(self, text: str) -> float:
        pairs = [text[i : i + 2] for i in range(len(text) - 1)]
        return sum(self.steps.get(p, RARE) for p in pairs) / max(1, len(pairs))

    def coverage(self, text: str) -> tuple[float, int]:
        """The part of a text that known words of four letters and more cover, and the longest."""
        covered = longest = at = 0
        while at < len(text):
            for end in range(min(len(text), at + LONGEST), at + SHORTEST - 1, -1):
                if text[at:end] in self.words:
                    covered, longest, at = covered + end - at, max(longest, end - at), end - 1
                    break
            at += 1
        return covered / max(1, len(text)), longest


def features(value: str, before: str, path: str, letters: Letters, after: str = "") -> list[float]:
    """The numbers named in :data:`FEATURES`; ``before`` and ``after`` are the text around, ``path`` where it is from."""
    n = len(value)
    lower = value.lower()
    counts = [value.count(c) for c in set(value)]
    kinds = ["d" if c.isdigit() else "a" if c.isalpha() else "s" for c in value]
    covered, longest = letters.coverage(lower)
    near, next_words = WORD.findall(before.lower()), WORD.findall(after.lower())
    assigned = re.search(r"[=:]\s*[\"']?$", before)
    last = near[-1] if near else ""
    place = path.lower()
    return [
        float(n),
        sum(c.isdigit() for c in value) / n,
        sum(c.isupper() for c in value) / n,
        float(all(c in "0123456789abcdef" for c in lower)),
        len(counts) / n,
        -sum(c / n * math.log2(c / n) for c in counts),
        sum(a.isupper() != b.isupper() for a, b in zip(value, value[1:]) if a.isalpha() and b.isalpha()) / n,
        sum(a != b for a, b in zip(kinds, kinds[1:])) / n,
        letters.transition(lower),
        covered,
        float(longest),
        float(bool(assigned)),
        float(before.endswith(('"', "'"))),
        float(last in NAMING),
        float(any(word in NAMING for word in near)),
        float(len(near)),
        float(len([p for p in re.split(r"[/\\]", place) if p])),
        float("test" in place or "example" in place or "doc" in place),
        float(bool(re.search(r"\.(py|js|java|go|c|cpp|sh|env|ya?ml|json|conf|ini)$", place))),
        float(bool(DUMMY.search(value))),
        float(any(word in NAMING for word in next_words)),
        float(len(next_words)),
    ]


def assigned(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of every value that is assigned to the name of a secret, whatever its length and characters.

    Of a chain ("auth: token=x") the values that end together are the first and the last of them.
    """
    chain: list[tuple[int, int]] = []
    run_end = 0
    for sign in SIGN.finditer(text):
        at = sign.start() if len(sign.group()) == 1 else sign.end()
        if not NAMED.search(text, max(0, at - 64), at):
            continue
        begin = GAP.match(text, sign.end()).end()
        quote = text[begin : begin + 1]
        held = QUOTED[quote].match(text, begin) if quote in QUOTED else None
        if held:
            begin, end = begin + 1, held.end() - 1
        else:
            begin += quote in QUOTED
            run_end = run_end if begin < run_end else PLAIN.match(text, begin).end()
            end = run_end
            while end > begin and text[end - 1] in ".:)]}>":
                end -= 1
        if end <= begin:
            continue
        if chain and chain[-1][1] != end:
            yield from {chain[0], chain[-1]}
            chain = []
        chain.append((begin, end))
    if chain:
        yield from {chain[0], chain[-1]}


def findings_of(text: str) -> Iterator[tuple[int, int, str, str, str]]:
    """Start, end, value and the text before and after of each candidate; one may lie inside another."""
    spans = {found.span() for found in CANDIDATE.finditer(text)}
    spans.update(assigned(text))
    spans.update(found.span(1) for found in IN_URL.finditer(text))
    for found in FORMED.finditer(text):
        if not re.match(r"[\w-]", text[found.start() - 1 : found.start()] or " "):
            spans.add(found.span())
    for start, end in sorted(spans):
        yield start, end, text[start:end], text[max(0, start - 48) : start], text[end : end + 48]


def _known_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word, n``: counts of a part of the texts; a word may come several times."""

    def counted() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
        )

    counts: Counter[str] = Counter()
    for batch in batches:
        for raw in texts_of(batch):
            text, at = raw.decode().lower(), 0
            while at < len(text):
                stop = NO_WORD.search(text, at + (1 << 20))
                end = stop.start() if stop else len(text)
                counts.update(WORD.findall(text, at, end))
                at = end
            if len(counts) > 200_000:  # a bound on memory only
                yield counted()
                counts.clear()
    if counts:
        yield counted()


def letters_of(docs: DataFrame, least: int = 3, part: int = 100_000_000) -> DataFrame:
    """``piece, weight``: steps of two letters with the log of their share, and known words with 0.

    Counted over all words of all texts. Known is a word of SHORTEST to LONGEST letters that
    stands ``least`` times, and once in ``part`` words of all: so letters that a secret holds
    by chance are no words, however large the table.
    """
    texts = docs.filter("text is not null").select(F.col("text").cast("string").alias("text"))
    counts = texts.mapInArrow(_known_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "secret-words")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    size = F.length("word")
    known = counts.filter(size.between(SHORTEST, LONGEST) & (F.col("n") >= max(least, -(-total // part))))
    pair = F.explode(F.expr("transform(sequence(1, length(word) - 1), i -> substring(word, i, 2))"))
    steps = counts.filter(size >= 2).select(pair.alias("piece"), "n").groupBy("piece").agg(F.sum("n").alias("n"))
    firsts = steps.groupBy(F.substring("piece", 1, 1).alias("_first")).agg(F.sum("n").alias("_all"))
    steps = steps.join(firsts, F.substring("piece", 1, 1) == F.col("_first"))
    weighed = steps.select("piece", F.log((F.col("n") + 1) / (F.col("_all") + 40)).alias("weight"))
    pieces = known.select(F.col("word").alias("piece"), F.lit(0.0).alias("weight")).unionByName(weighed)
    return materialize(pieces, "secret-letters")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, piece``: all that could be a step or a known word in a value."""
    for batch in batches:
        for key, raw in zip(batch.column("key").to_pylist(), texts_of(batch, "value")):
            found = set()
            for run in WORD.findall(raw.decode().lower()):
                for size in (2, *range(SHORTEST, LONGEST + 1)):
                    found.update(run[at : at + size] for at in range(len(run) - size + 1))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(found), pa.string()), pa.array(sorted(found), pa.string())], ["key", "piece"]
                )


def with_features(rows: DataFrame, letters: Letters | DataFrame) -> DataFrame:
    """Adds ``features``. ``letters`` of :func:`letters_of` are joined: every value meets only its own pieces."""
    columns = "value", "before", "path", F.col("after") if "after" in rows.columns else F.lit("")
    if isinstance(letters, Letters):

        @F.pandas_udf("array<double>")
        def run(value: pd.Series, before: pd.Series, path: pd.Series, after: pd.Series) -> pd.Series:
            return pd.Series([features(v, b, p, letters, a) for v, b, p, a in zip(value, before, path, after)])

        return rows.withColumn("features", run(*columns))

    @F.pandas_udf("array<double>")
    def run(
        value: pd.Series, before: pd.Series, path: pd.Series, after: pd.Series, pieces: pd.Series, weights: pd.Series
    ) -> pd.Series:
        out = []
        for *row, behind, names, logs in zip(value, before, path, after, pieces, weights):
            known = {} if names is None else dict(zip(names, map(float, logs)))
            words = frozenset(piece for piece in known if len(piece) >= SHORTEST)
            local = Letters(words=words, steps={p: w for p, w in known.items() if len(p) == 2})
            out.append(features(*row, local, behind))
        return pd.Series(out)

    keyed = rows.withColumn("_key", F.md5(F.col("value").cast("binary")))
    values = keyed.select(F.col("_key").alias("key"), "value").distinct()
    known = (
        values.mapInArrow(_pieces, "key string, piece string")
        .join(letters, "piece")
        .groupBy("key")
        .agg(F.collect_list(F.struct("piece", "weight")).alias("_known"))
    )
    met = keyed.join(known, F.col("_key") == F.col("key"), "left")
    met = met.withColumn("features", run(*columns, "_known.piece", "_known.weight"))
    return met.select(*rows.columns, "features")


def candidates(docs: DataFrame, path: str = "source") -> DataFrame:
    """``doc_id, start, end, value, before, path, after`` of all candidates; whole texts are searched."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "end", "value", "before", "path", "after"]
        types = [pa.int64(), pa.int32(), pa.int32(), *[pa.string()] * 4]
        for batch in batches:
            rows = []
            columns = batch.column("doc_id").to_pylist(), texts_of(batch), batch.column("path").to_pylist()
            for doc_id, text, place in zip(*columns):
                rows += [(doc_id, s, e, v, b, place, a) for s, e, v, b, a in findings_of(text.decode())]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"),
    )
    schema = "doc_id long, start int, end int, value string, before string, path string, after string"
    return rows.filter(F.col("text").rlike(HINT)).mapInArrow(run, schema)


def train(
    labelled: DataFrame, letters: Letters | DataFrame, per_label: int = 2000, trees: int = 40, depth: int = 8, seed: int = 3
) -> RandomForestClassificationModel:
    """A forest over at most ``per_label`` different findings of each label, taken by a hash.

    ``labelled`` has ``value, before, path, label`` (0 or 1; null labels are left
    out) and may have ``after``. A finding that is repeated is learned once.
    """
    after = F.col("after") if "after" in labelled.columns else F.lit("")
    text = [F.coalesce(c, F.lit("")).alias(n) for n, c in (("before", "before"), ("path", "path"), ("after", after))]
    key = ["value", "before", "path", "after"]
    kept = labelled.filter("label in (0, 1) and value is not null and value != ''")
    kept = materialize(kept.select("value", *text, F.col("label").cast("int")).distinct(), "secret-labelled")
    kept = kept.withColumn("_at", F.xxhash64(*key))
    counts = {row["label"]: row["count"] for row in kept.groupBy("label").count().collect()}  # two rows
    rows = None
    for label in (0, 1):
        some = least_hashed(
            kept.filter(F.col("label") == label), counts.get(label, 0), "_at", key, per_label
        )
        rows = some if rows is None else rows.unionByName(some)
    # Stored before the features: the rows are picked once.
    rows = materialize(rows.select(*key, F.col("label").cast("double")), "secret-picked")
    vectors = materialize(with_features(rows, letters).select(F.col("features").alias("f"), "label"), "secret-sample")
    vectors = vectors.select(array_to_vector("f").alias("features"), "label")
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt").fit(vectors)


def score(found: DataFrame, model: RandomForestClassificationModel, letters: Letters | DataFrame) -> DataFrame:
    """Adds ``probability`` that a candidate is a secret."""
    vectors = with_features(found, letters).withColumn("features", array_to_vector("features"))
    return model.transform(vectors).withColumn("probability", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "prediction"
    )


def rule_label() -> Column:
    """1 for what has a published form of keys, stands as a URL's password, or is assigned to a name of a secret and looks random.

    0 for what has none of these marks, and for placeholders and calls under such a
    name. Between the two nothing is labelled. Stands in for labels by hand, where
    there are none.
    """
    value, before = F.col("value"), F.col("before")
    formed = value.rlike(FORMS)
    name = r"(?i)({})\w*[\"']?\s*[=:]\s*[\"']?$"
    named = before.rlike(name.format(r"token|secret|passw(or)?d|api_?key|auth"))
    random = value.rlike(r"^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9_+/=-]{16,}$")
    stand_in = value.rlike(r"(?i)example|placeholder|changeme|dummy|your|x{4}|^[$<{%]|^[A-Za-z_.]+\(|^(none|null|true|false)$")
    short = before.rlike(name.format(r"secret|passw(or)?d|pwd|passphrase"))
    mixed = value.rlike(r"^(?=.*[0-9])(?=.*[A-Za-z])\S{6,}$") & ~stand_in
    in_url = before.rlike(r"://[^\s:/@]*:$") & ~stand_in & F.col("after").startswith("@")
    near = before.rlike(r"(?i)token|secret|pass|pwd|key|auth|credential|private|access|bearer|://[^\s:/@]*:$")
    return F.when(formed | (named & random) | (short & mixed) | in_url, 1).when(~near | stand_in, 0)


def scan(
    docs: DataFrame, labelled: DataFrame | None = None, path: str = "source", threshold: float = 0.5
) -> DataFrame:
    """Candidates with ``probability`` and ``is_secret``: ``doc_id, start, end, value_crc32`` and both.

    ``labelled`` are findings with a label, see :func:`train`; without them the
    candidates themselves serve, labelled by :func:`rule_label`. If a label has no
    finding there is nothing to learn, and the rule decides (0.5 where it is silent).
    Positions count characters. Values do not leave the operator, only their crc32.

    A null or empty text has no candidates; neither has an empty table. Repeated
    rows repeat their findings. Only ``doc_id, text`` and the path column are read;
    a null path counts as empty.
    """
    found = materialize(candidates(docs, path), "secret-candidates")
    known = found.withColumn("label", rule_label()) if labelled is None else labelled
    counts = known.agg(F.count(F.when(F.col("label") == 1, 1)), F.count(F.when(F.col("label") == 0, 1))).first()
    if all(counts):
        letters = letters_of(docs)
        scored = score(found, train(known, letters), letters)
    else:
        scored = found.withColumn("probability", F.coalesce(rule_label().cast("double"), F.lit(0.5)))
    return scored.select(
        "doc_id",
        "start",
        "end",
        F.crc32("value").alias("value_crc32"),
        "probability",
        (F.col("probability") > threshold).alias("is_secret"),
    )
