"""The inputs of the five kinds of work, derived from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.operators.graph import Graph, build_graph
from rillflow.operators.vocabulary import admit, kept_texts, new_words
from rillflow.session import materialize, new_scratch, over_cores
from rillflow.sources.logs import good_lines, parse_lines
from rillflow.sources.tables import from_values

# Fixed value: the vertex of an id that only edges name.
UNKNOWN_PERSON = {"name": "John Doe", "age": -1}
BATCHES = 12

# Labels of the ballot positions.
FRIENDLY_ORDERS = (
    ("1", "First on Ballot"),
    ("2", "Second on Ballot"),
    ("3", "In Middle of Ballot"),
    ("4", "Fourth on Ballot"),
    ("5", "Last on Ballot"),
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def access_log(spark: SparkSession, sf: str) -> DataFrame:
    """``event_id``, ``line``: a log line per event; events of hardly any value left garbled lines.

    Some lines have the right form but a month, a day or a size that is none.
    """
    event = F.col("event_type")
    status = (
        F.when(event == "error", "404").when(event == "signup", "302").when(event == "click", "304")
        .otherwise("200")
    )
    turn = F.col("event_id") % 100
    size = (
        F.when(turn == 7, "12kB").when(event == "signup", "-")
        .otherwise(F.floor(F.col("value") * 100).cast("string"))
    )
    time = (
        F.when(turn == 8, "01/Xyz/2024:10:00:00").when(turn == 9, "31/Feb/2024:10:00:00")
        .otherwise(F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"))
    )
    line = F.concat(
        F.lit("user"), F.col("user_id").cast("string"), F.lit(".example.com - - ["),
        time, F.lit(' -0400] "GET /'), event, F.lit("/"),
        F.regexp_extract("props", "[0-9]+", 0), F.lit(' HTTP/1.0" '), status, F.lit(" "), size,
    )
    garbled = F.concat(F.lit("bad line "), F.col("event_id").cast("string"))
    return over_cores(table(spark, sf, "events"), "event_id").select(
        "event_id", F.when(F.col("value") < 1, garbled).otherwise(line).alias("line")
    )


def logs(spark: SparkSession, sf: str) -> DataFrame:
    return good_lines(parse_lines(access_log(spark, sf)))


def ballots(spark: SparkSession, sf: str) -> DataFrame:
    """All columns are text; provisional orders have no numeric precinct."""
    customer = F.col("o_custkey").cast("string")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("ballot_id"),
        F.col("o_orderpriority").alias("candidate_name"),
        F.substring("o_orderpriority", 1, 1).alias("candidate_ballot_order"),
        F.when(F.col("o_orderstatus") == "P", "##PROV").otherwise(customer).alias("precinct_code"),
        F.concat(F.lit("Precinct "), customer).alias("precinct_name"),
        F.floor(F.col("o_totalprice") / 1000).cast("string").alias("total_votes"),
    )


def friendly_orders(spark: SparkSession) -> DataFrame:
    return from_values(spark, FRIENDLY_ORDERS, "candidate_ballot_order string, friendly_name string")


def people(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        (F.col("c_custkey") % 60 + 18).cast("int").alias("age"),
    )


def likes(spark: SparkSession, sf: str) -> DataFrame:
    """From the customer of an order to that of the next order."""
    orders = table(spark, sf, "orders")
    first = orders.select(F.col("o_custkey").alias("src"), (F.col("o_orderkey") + 1).alias("key"))
    second = orders.select(F.col("o_custkey").alias("dst"), F.col("o_orderkey").alias("key"))
    return (
        first.join(second, "key")
        .filter(F.col("src") != F.col("dst"))
        .select("src", "dst")
        .distinct()
        .withColumn("attr", ((F.col("src") * 7 + F.col("dst")) % 9 + 1).cast("int"))
    )


def social_graph(spark: SparkSession, sf: str) -> Graph:
    return build_graph(people(spark, sf), materialize(likes(spark, sf), "likes"), UNKNOWN_PERSON)


def partly_known_graph(spark: SparkSession, sf: str) -> Graph:
    """The same edges, but customers with debts are known from the edges only."""
    solvent = table(spark, sf, "customer").filter("c_acctbal >= 0").select(F.col("c_custkey").alias("id"))
    known = people(spark, sf).join(solvent, "id", "left_semi")
    return build_graph(known, materialize(likes(spark, sf), "likes"), UNKNOWN_PERSON)


def tagged_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with the distinct words of their text as tags; equal texts are the same entity."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)")))
    return over_cores(table(spark, sf, "documents"), "doc_id").select(
        F.col("doc_id").alias("id"), F.col("text").alias("title"), F.col("lang").alias("artist"),
        words.alias("tags"),
    )


def tag_files(spark: SparkSession, sf: str) -> tuple[str, str, str]:
    """Parts as an entity file, a tag file by line number and a tag-name file; their paths.

    Small parts have no tags. Type tags are missing from the names.
    """
    root = new_scratch(spark, "tag-files")
    part = table(spark, sf, "part")
    brand = F.regexp_extract("p_brand", "[0-9]+", 0)
    part.select(
        F.concat_ws("\t", F.col("p_partkey").cast("string"), "p_name", "p_brand").alias("value")
    ).write.text(f"{root}/entities")
    tags = F.concat_ws(
        " ", brand, (F.col("p_size") + 100).cast("string"),
        (F.length("p_type") + 1000).cast("string"), brand,
    )
    part.repartitionByRange("p_partkey").sortWithinPartitions("p_partkey").select(
        F.when(F.col("p_type") == "SMALL", "#").otherwise(tags).alias("value")
    ).write.text(f"{root}/tags")
    names = (
        part.select(F.concat(brand, F.lit(", "), F.col("p_brand")).alias("value"))
        .union(part.select(F.format_string("%d, size %d", F.col("p_size") + 100, "p_size")))
        .distinct()
    )
    names.write.text(f"{root}/names")
    return f"{root}/entities", f"{root}/tags", f"{root}/names"


def short_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as short texts with a link; each fifth one reposts another. ``batch`` is its arrival."""
    documents = over_cores(table(spark, sf, "documents"), "doc_id")
    original = documents.select(
        (F.col("doc_id") * 5).alias("doc_id"), F.col("text").alias("retweet_text")
    )
    text = F.concat("text", F.lit(" http://t.example/"), F.col("doc_id").cast("string")).alias("text")
    return documents.join(original, "doc_id", "left").select(
        "doc_id", text, "lang", "retweet_text", (F.col("doc_id") % BATCHES).cast("int").alias("batch")
    )


def english_texts(spark: SparkSession, sf: str) -> DataFrame:
    return kept_texts(short_texts(spark, sf))


def no_words(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "word string, id int, vector array<double>")


def contenders(spark: SparkSession, sf: str, texts: DataFrame | None = None) -> DataFrame:
    """The contender counts after all batches, if none was admitted on the way.

    ``texts`` are the English texts, if the caller has them already.
    """
    texts = english_texts(spark, sf) if texts is None else texts
    seen = new_words(texts, no_words(spark), "batch")
    return seen.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def first_vocabulary(spark: SparkSession, sf: str, length: int,
                     texts: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The words of more than ten batches with their first vectors and weights."""
    vocab, weights, _ = admit(contenders(spark, sf, texts), 0, length)
    return vocab, weights


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("word"), F.col("embedding").cast("array<double>").alias("vector"), "label"
    )
