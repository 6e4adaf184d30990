"""Every operator as a query on the test tables: name to ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillflow.functions.text import contains_digit
from rillflow.operators import clustering, embedding, graph, layout, logs, nearest, pivots, propagate, relational, similarity, vocabulary
from rillflow.operators.components import connected_components
from rillflow.plans import views
from rillflow.session import materialize, new_scratch
from rillflow.sources import feed, keyed, streams, tables, tags
from rillflow.sources.paths import delete, exists
from rillflow.sources.logs import bad_lines, parse_lines, parse_report, read_access_log
from rillflow.streaming import running_mean, training

Query = Callable[[SparkSession, str], DataFrame]

LENGTH = 4
CONTEXT = 2
RATE = 0.05
NUDGE = 1e-9  # keeps exact halves from rounding down on one side and up on the other


# Access logs


def log_parse(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parse_lines(views.access_log(spark, sf)).filter("ok")
    return parsed.select(
        "event_id", "host", "client_id", "user_id", "date_time", "method", "endpoint", "protocol",
        "status", "size",
    )


def log_bad_lines(spark: SparkSession, sf: str) -> DataFrame:
    bad = bad_lines(parse_lines(views.access_log(spark, sf)))
    return bad.orderBy("event_id").limit(20)


def log_parse_report(spark: SparkSession, sf: str) -> DataFrame:
    return parse_report(parse_lines(views.access_log(spark, sf)))


def log_text_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = new_scratch(spark, "access-log")
    views.access_log(spark, sf).select("line").write.text(path)
    parsed = read_access_log(spark, path)
    return parsed.groupBy("ok", "status").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))


def _on_logs(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: operator(views.logs(spark, sf))


def log_size_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = logs.size_stats(views.logs(spark, sf))
    return stats.withColumn("avg_size", F.round("avg_size", 6))


def log_weekly_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """Hosts per week of the month, and whether the sum of the days' sketches is within 5 % of that."""
    rows = views.logs(spark, sf)
    sketches = materialize(logs.daily_host_sketches(rows), "host-sketches")
    week = F.floor((F.col("day") - 1) / F.lit(7)).cast("int")
    about = logs.hosts_of_sketches(sketches, week=week).withColumnRenamed("n_hosts", "about")
    exact = rows.withColumn("day", F.dayofmonth("date_time")).groupBy(week.alias("week")).agg(
        F.count_distinct("host").alias("n_hosts")
    )
    close = F.abs(F.col("about") - F.col("n_hosts")) <= F.col("n_hosts") * 0.05
    return exact.join(about, "week").select("week", "n_hosts", close.alias("close"))


# Relational queries


def rel_friendly_order(spark: SparkSession, sf: str) -> DataFrame:
    return relational.friendly_order(views.ballots(spark, sf), views.friendly_orders(spark))


def rel_total_sum(spark: SparkSession, sf: str) -> DataFrame:
    total = relational.total_of(views.ballots(spark, sf), "total_votes")
    return total.withColumnRenamed("sum(total_votes_int)", "total_votes")


def rel_sum_all(spark: SparkSession, sf: str) -> DataFrame:
    """Every numeric column of the orders summed, and the number in their priority."""
    orders = views.table(spark, sf, "orders").withColumn("priority", F.substring("o_orderpriority", 1, 1))
    sums = relational.total_of(orders, "priority")
    return sums.select(
        F.col("sum(o_orderkey)").alias("sum_key"), F.col("sum(o_custkey)").alias("sum_customer"),
        F.round("sum(o_totalprice)", 2).alias("sum_price"), F.col("sum(priority_int)").alias("sum_priority"),
    )


def rel_json_head(spark: SparkSession, sf: str) -> DataFrame:
    path = new_scratch(spark, "ballots")
    tables.write_json(views.ballots(spark, sf), path)
    _, head = tables.schema_and_head(tables.read_json(spark, path), 2, "ballot_id")
    return head


def rel_json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """All four write modes: overwrite twice, append once, ignore once; error must refuse."""
    path = new_scratch(spark, "json")
    totals = relational.total_by(views.ballots(spark, sf), "candidate_name", "total_votes")
    for mode in ("error", "overwrite", "append", "ignore"):
        tables.write_json(totals, path, mode)
    return tables.read_json(spark, path, "candidate_name string, sum_column bigint")


def rel_json_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Ballots written as JSON lines, read with the inferred schema, then the top precinct."""
    path = new_scratch(spark, "ballots")
    tables.write_json(views.ballots(spark, sf), path)
    read = tables.read_json(spark, path)
    return relational.top_valid_group(read, "precinct_code", "precinct_name", "total_votes")


def rel_json_variant(spark: SparkSession, sf: str) -> DataFrame:
    """Votes per candidate from JSON lines of which some are cut off and some have votes as numbers.

    The row without a candidate counts the broken lines.
    """
    path = new_scratch(spark, "ballots")
    ballots, number = views.ballots(spark, sf), F.col("ballot_id").cast("bigint")
    names = [c for c in ballots.columns if c != "total_votes"]
    drifting = F.to_json(F.struct(*names, F.col("total_votes").cast("bigint").alias("total_votes")))
    line = F.when(number % 7 == 1, drifting).otherwise(F.to_json(F.struct(*names, "total_votes")))
    ballots.select(F.when(number % 50 == 3, F.substring(line, 1, 30)).otherwise(line).alias("value")).write.text(path)
    read, broken, _ = tables.read_variant_json(spark, path)
    texts = read.select("candidate_name", F.col("total_votes").cast("string").alias("total_votes"))
    sums = relational.total_by(texts, "candidate_name", "total_votes")
    lost = broken.agg(F.lit(None).cast("string").alias("candidate_name"), F.count(F.lit(1)).alias("sum_column"))
    return sums.unionByName(lost)


# Graphs


def _on_graph(operator: Callable[[graph.Graph], DataFrame]) -> Query:
    return lambda spark, sf: operator(views.social_graph(spark, sf))


def _flat_triplets(g: graph.Graph) -> DataFrame:
    return graph.triplets(g).select(
        "src", "dst", "attr", F.col("src_attr.name").alias("src_name"),
        F.col("dst_attr.name").alias("dst_name"),
    )


def _adults(g: graph.Graph) -> graph.Graph:
    return graph.subgraph(g, vertex=F.col("age") >= 30)


def _adult_edges(g: graph.Graph) -> DataFrame:
    return graph.subgraph(g, vertex=F.col("age") >= 30, edge=F.col("attr") > 2).edges


def _renamed(g: graph.Graph) -> DataFrame:
    """Vertices rewritten, then updated only where a follower is known."""
    older = graph.map_vertices(g, age=F.col("age") + 1)
    joined = graph.join_vertices(
        older, graph.oldest_follower(g), lambda _: {"name": F.concat("name", F.lit("<"), "follower_name")}
    )
    return joined.vertices.select("id", "name", "age")


def _both_ways(g: graph.Graph) -> DataFrame:
    """Messages along and against the edges: neighbours' ages summed at both ends."""
    return graph.aggregate_messages(
        g, [F.count("msg").alias("n"), F.sum("msg").alias("age_sum")],
        to_dst=F.col("src_attr.age"), to_src=F.col("dst_attr.age"),
    )


def graph_two_rounds(spark: SparkSession, sf: str) -> DataFrame:
    """The ages of followers summed, then those sums passed on to both sides, on a stored layout."""
    stored = layout.store(views.social_graph(spark, sf))
    ages = layout.aggregate_messages(stored, [F.sum("msg").alias("s")], to_dst=F.col("src_attr.age"))
    sums = stored.vertices.join(ages, "id", "left").select("id", F.coalesce("s", F.lit(0)).alias("s"))
    stored = layout.with_vertices(stored, sums)
    return layout.aggregate_messages(
        stored, [F.sum("msg").alias("total")], to_dst=F.col("src_attr.s"), to_src=F.col("dst_attr.s")
    )


def graph_avg_follower_age(spark: SparkSession, sf: str) -> DataFrame:
    g = views.social_graph(spark, sf)
    mean = graph.average_follower_age(g)
    return graph.left_join_vertices(g, mean).select(
        "id", "name", F.round("avg_age", 6).alias("avg_age")
    )


def graph_without_edges(spark: SparkSession, sf: str) -> DataFrame:
    g = graph.without_edges(views.people(spark, sf))
    return connected_components(g)


# Tags and similarity


def tags_enrich(spark: SparkSession, sf: str) -> DataFrame:
    entities, tag_lines, names = views.tag_files(spark, sf)
    enriched = similarity.enrich_with_tags(
        tags.read_entities(spark, entities), tags.read_tag_ids(spark, tag_lines),
        tags.read_tag_names(spark, names),
    )
    return enriched.vertices.select("id", "title", "artist", F.array_join("tags", "|").alias("tags"))


def tags_similar_pairs(spark: SparkSession, sf: str) -> DataFrame:
    pairs = similarity.similar_pairs(views.tagged_documents(spark, sf))
    return pairs.withColumn("score", F.round("score", 9))


def tags_similar_graph(spark: SparkSession, sf: str) -> DataFrame:
    g = similarity.well_tagged(similarity.similarity_graph(views.tagged_documents(spark, sf)))
    # An edge takes the number of tags of its ends along, not their texts.
    counted = g.vertices.select("id", F.size("tags").alias("n_tags"))
    edges = graph.triplets(graph.Graph(counted, g.edges), ("dst", "src"))
    return edges.select(
        "src", "dst", F.col("src_attr.n_tags").alias("src_tags"),
        F.col("dst_attr.n_tags").alias("dst_tags"), F.round("score", 9).alias("score"),
    )


def tags_similar_sets(spark: SparkSession, sf: str) -> DataFrame:
    links, _ = similarity.similar_sets(views.tagged_documents(spark, sf))
    return links.withColumn("score", F.round("score", 9))


def tags_set_members(spark: SparkSession, sf: str) -> DataFrame:
    """Which set each tagged document has; with the links of sets, all links of documents."""
    _, members = similarity.similar_sets(views.tagged_documents(spark, sf))
    return members.select("id", "set_id")


def tags_link_counts(spark: SparkSession, sf: str) -> DataFrame:
    """How many documents each one is similar to, without a row for every pair."""
    return similarity.link_counts(views.tagged_documents(spark, sf))


def tags_set_graph(spark: SparkSession, sf: str) -> DataFrame:
    """The graph of sets: a row per set of tags with the sets it is similar to."""
    g = similarity.set_graph(views.tagged_documents(spark, sf))
    return graph.with_degrees(g).vertices.select("id", "n_members", "in_degree", "out_degree")


def graph_pic_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Which documents are clustered."""
    return graph_pic(spark, sf).select("id")


def graph_pic(spark: SparkSession, sf: str) -> DataFrame:
    return clustering.power_clusters(similarity.similarity_graph(views.tagged_documents(spark, sf)), k=4)


def graph_hops(spark: SparkSession, sf: str) -> DataFrame:
    """Hops along the edges from the customer with the lowest number that has an edge out."""
    g = views.social_graph(spark, sf)
    return propagate.hops(g, g.edges.agg(F.min("src").alias("id")))


def graph_cheapest(spark: SparkSession, sf: str) -> DataFrame:
    """The least sum of edge attributes on a way from that customer."""
    g = views.social_graph(spark, sf)
    return propagate.cheapest(g, g.edges.agg(F.min("src").alias("id")), "attr")


# Nearest vectors


def vec_nearest(spark: SparkSession, sf: str) -> DataFrame:
    found = nearest.nearest(views.vectors(spark, sf), 0, 10)
    return found.withColumn("distance", F.round("distance", 6))


def vec_nearest_batch(spark: SparkSession, sf: str) -> DataFrame:
    """The five nearest of every vector whose number is divisible by 50, which are the requests."""
    vectors = views.vectors(spark, sf)
    queries = vectors.filter("word % 50 = 0").select("word", F.lit(5).alias("n"))
    found = nearest.nearest_many(vectors, queries)
    return found.select("query", "rank", "word", F.round("distance", 6).alias("distance"), "percent")


def vec_nearest_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """The same requests through an index of pivots."""
    vectors = views.vectors(spark, sf)
    path = new_scratch(spark, "pivot-index")
    pivots.build_index(vectors, path, rows_per_block=64)
    queries = vectors.filter("word % 50 = 0").select("word", F.lit(5).alias("n"))
    found, _ = pivots.nearest_indexed(pivots.open_index(spark, path), queries)
    return found.select("query", "rank", "word", F.round("distance", 6).alias("distance"), "percent")


def vec_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Typed requests, one per word of the texts: the valid ones answered, known or not."""
    vocab, _ = views.first_vocabulary(spark, sf, LENGTH)
    vocab = materialize(vocab, "vocab")
    lines = views.contenders(spark, sf).select(
        F.concat(F.upper("word"), F.lit(" "), F.least(F.col("n"), F.lit(3)).cast("string")).alias("line")
    )
    requests = materialize(nearest.parse_requests(lines).filter("valid"), "requests")
    found = nearest.nearest_many(vocab, requests)
    return found.select(
        "query", "n", "known", "rank", "word", F.round("distance", 6).alias("distance")
    )


# Streams


def _slices(events: DataFrame, key: str, n: int) -> list[DataFrame]:
    """The table cut into n stretches of its key, for arrival one after the other."""
    top = events.agg(F.max(key)).first()[0] + 1
    return [
        events.filter((F.col(key) >= top * i // n) & (F.col(key) < top * (i + 1) // n)) for i in range(n)
    ]


def stream_running_avg(spark: SparkSession, sf: str) -> DataFrame:
    root = new_scratch(spark, "running-mean")
    line = F.concat_ws(",", "event_type", F.col("value").cast("string"))
    for part in _slices(views.table(spark, sf, "events"), "event_id", 3):
        part.select(line.alias("value")).write.mode("append").text(f"{root}/in")
        pairs = streams.keyed_numbers(streams.text_lines(spark, f"{root}/in"))
        running_mean.write_running_mean(
            pairs, f"{root}/avg", f"{root}/checkpoint", every=None
        ).awaitTermination()
    return running_mean.read_running_mean(spark, f"{root}/avg").select(
        "word", F.round(F.col("count").cast("double"), 3).alias("mean")
    )


def stream_feed_means(spark: SparkSession, sf: str) -> DataFrame:
    """The running means again, from a log that is read by row number."""
    root = new_scratch(spark, "feed-mean")
    line = F.concat_ws(",", "event_type", F.col("value").cast("string"))
    for part in _slices(views.table(spark, sf, "events"), "event_id", 3):
        feed.append(part.select(line.alias("value")), f"{root}/feed")
        pairs = streams.keyed_numbers(feed.feed_rows(spark, f"{root}/feed", "value string", 50_000))
        running_mean.write_running_mean(
            pairs, f"{root}/avg", f"{root}/checkpoint", every=None
        ).awaitTermination()
    return running_mean.read_running_mean(spark, f"{root}/avg").select(
        "word", F.round(F.col("count").cast("double"), 3).alias("mean")
    )


def stream_running_avg_trace(spark: SparkSession, sf: str) -> DataFrame:
    root = new_scratch(spark, "mean-trace")
    line = F.concat_ws(",", "event_type", F.col("value").cast("string"))
    for part in _slices(views.table(spark, sf, "events"), "event_id", 3):
        part.select("event_id", line.alias("value")).write.mode("append").parquet(f"{root}/in")
        rows = streams.parquet_rows(spark, f"{root}/in", "event_id bigint, value string")
        running_mean.write_mean_trace(
            streams.keyed_numbers(rows), "event_id", f"{root}/out", f"{root}/checkpoint",
            every=None, width=1000,
        ).awaitTermination()
    return running_mean.read_mean_trace(spark, f"{root}/out").select(
        "event_id", "word", F.round(F.col("mean") + NUDGE, 6).alias("mean")
    )


def keyed_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Events upserted by user in four batches: the last value of each user.

    After two batches another writer goes on, as a stream with a new checkpoint does,
    its batches numbered from 0; its second batch comes twice.
    """
    path = f"{new_scratch(spark, 'keyed')}/last"
    keyed.create_table(spark, path, "user_id bigint, last_event bigint, value double")
    newest = F.max_by(F.struct("event_id", "value"), "event_id")
    arrivals = [("one", 0), ("one", 1), ("two", 0), ("two", 1)]
    for (writer, batch), part in zip(arrivals, _slices(views.table(spark, sf, "events"), "event_id", 4)):
        rows = part.groupBy("user_id").agg(newest.alias("m")).select(
            "user_id", F.col("m.event_id").alias("last_event"), "m.value"
        )
        for _ in range(1 + (writer == "two" and batch == 1)):
            keyed.upsert(rows, path, ["user_id"], batch, full_every=3, writer=writer)
    return keyed.read_table(spark, path, ["user_id"])


def keyed_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Events upserted by user to a table in buckets, then the users whose number 50 divides."""
    path = f"{new_scratch(spark, 'keyed')}/buckets"
    keyed.create_table(spark, path, "user_id bigint, last_event bigint, value double", buckets=16)
    events = views.table(spark, sf, "events")
    newest = F.max_by(F.struct("event_id", "value"), "event_id")
    for batch, part in enumerate(_slices(events, "event_id", 3)):
        rows = part.groupBy("user_id").agg(newest.alias("m")).select(
            "user_id", F.col("m.event_id").alias("last_event"), "m.value"
        )
        keyed.upsert(rows, path, ["user_id"], batch, full_every=2)
    return keyed.lookup(spark, path, ["user_id"], events.select("user_id").filter("user_id % 50 = 0"))


#: Where the state trained on a folder of tables lies, by application.
_TRAINED: dict[tuple[str, str], str] = {}


def _train(spark: SparkSession, sf: str) -> str:
    """All texts, one batch after the other; the folder with the state, made once while it is there."""
    key = (spark.sparkContext.applicationId, sf)
    if key in _TRAINED and exists(spark, f"{_TRAINED[key]}/done"):
        return _TRAINED[key]
    root = new_scratch(spark, "training")
    _TRAINED[key] = f"{root}/state"
    settings = training.Settings(length=LENGTH, context=CONTEXT, rate=RATE, snapshot_every=5, every=None)
    arrivals = views.short_texts(spark, sf)
    for batch in range(views.BATCHES):
        arrivals.filter(F.col("batch") == batch).drop("batch").write.mode("append").parquet(f"{root}/in")
        texts = streams.parquet_rows(spark, f"{root}/in", streams.SHORT_TEXT_SCHEMA)
        training.train_stream(
            texts, f"{root}/state", f"{root}/checkpoint", settings, snapshots=f"{root}/snapshots"
        ).awaitTermination()
    return f"{root}/state"


def stream_train_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return training.read_metrics(spark, _train(spark, sf))


def stream_train_vocab(spark: SparkSession, sf: str) -> DataFrame:
    """The vocabulary after the last batch, which is the first one to train."""
    return _long(training.load_state(spark, _train(spark, sf))["vocab"], "id", "word")


def stream_train_restored(spark: SparkSession, sf: str) -> DataFrame:
    """A new state started from the newest snapshot, which is from the last batch but one."""
    root = _train(spark, sf).rsplit("/", 1)[0]
    training.create_state(spark, f"{root}/restored", f"{root}/snapshots")
    return _long(training.load_state(spark, f"{root}/restored")["vocab"], "id", "word")


def stream_train_weights(spark: SparkSession, sf: str) -> DataFrame:
    return _long(training.load_state(spark, _train(spark, sf))["weights"], "id")


# Vocabulary and training


def text_tokens(spark: SparkSession, sf: str) -> DataFrame:
    texts = views.english_texts(spark, sf).select("doc_id", "text")
    words = vocabulary.text_tokens(texts)
    in_order = Window.partitionBy("doc_id").orderBy("pos")
    return words.select(
        "doc_id", F.row_number().over(in_order).alias("position"), "word",
        contains_digit(F.col("word")).alias("has_digit"),
    )


def text_digits(spark: SparkSession, sf: str) -> DataFrame:
    """How many words of the raw texts hold a digit."""
    words = F.split("text", "[ \t\r\n]+")
    return views.english_texts(spark, sf).select("doc_id", F.size(F.filter(words, contains_digit)).alias("n"))


def text_new_words(spark: SparkSession, sf: str) -> DataFrame:
    vocab, _ = _written_vocabulary(spark, sf)
    return vocabulary.new_words_by_text(views.english_texts(spark, sf), vocab)


def text_new_words_filtered(spark: SparkSession, sf: str) -> DataFrame:
    """The same when the vocabulary is too large to be broadcast: by a filter of bounded size."""
    vocab, _ = _written_vocabulary(spark, sf)
    return vocabulary.new_words_by_text(views.english_texts(spark, sf), vocab, broadcast_bytes=0)


def contender_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Batch after batch added to the counts of those before, which are stored in between.

    As one plan all additions may share a task, each with a table of all words.
    """
    seen = materialize(
        vocabulary.new_words(views.english_texts(spark, sf), views.no_words(spark), "batch"), "seen"
    )
    root = new_scratch(spark, "contender-counts")
    counts = spark.createDataFrame([], "word string, n bigint")
    for batch in range(views.BATCHES):
        added = vocabulary.count_contenders(counts, seen.filter(F.col("batch") == batch))
        added.write.parquet(f"{root}/batch={batch}")
        counts = spark.read.schema(added.schema).parquet(f"{root}/batch={batch}")
        if batch:
            delete(spark, f"{root}/batch={batch - 1}")
    return counts


def contender_decay(spark: SparkSession, sf: str) -> DataFrame:
    return vocabulary.decay_contenders(views.contenders(spark, sf))


def _long(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.select(*keys, F.posexplode("vector").alias("dim", "value")).withColumn(
        "value", F.round("value", 6)
    )


def vocab_admission(spark: SparkSession, sf: str) -> DataFrame:
    vocab, weights = views.first_vocabulary(spark, sf, LENGTH)
    words = vocab.select("id", "word")
    return _long(vocab, "id", "word").withColumn("kind", F.lit("word")).unionByName(
        _long(weights.join(words, "id"), "id", "word").withColumn("kind", F.lit("weight"))
    )


def _written_vocabulary(spark: SparkSession, sf: str,
                        texts: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    vocab, weights = views.first_vocabulary(spark, sf, LENGTH, texts)
    return materialize(vocab, "vocab"), materialize(weights, "weights")


def _written_texts(spark: SparkSession, sf: str) -> DataFrame:
    """The English texts, joined to their originals once for both the vocabulary and the step."""
    return materialize(views.english_texts(spark, sf), "texts")


def emb_context(spark: SparkSession, sf: str) -> DataFrame:
    texts = _written_texts(spark, sf)
    vocab, _ = _written_vocabulary(spark, sf, texts)
    totals = embedding.text_totals(texts, vocab, CONTEXT)
    return totals.withColumn("weight", F.round("weight", 6))


def emb_softmax(spark: SparkSession, sf: str) -> DataFrame:
    vocab, weights = _written_vocabulary(spark, sf)
    sums = embedding.log_sums(vocab, weights, weights.count())
    return sums.withColumn("log_sum", F.round("log_sum", 6))


def emb_gradients(spark: SparkSession, sf: str) -> DataFrame:
    texts = _written_texts(spark, sf)
    vocab, weights = _written_vocabulary(spark, sf, texts)
    totals = embedding.text_totals(texts, vocab, CONTEXT)
    grads = embedding.gradients(totals, vocab, weights, weights.count(), LENGTH)
    return grads.select("side", "id", F.posexplode("grad").alias("dim", "value")).withColumn(
        "value", F.round("value", 6)
    )


def emb_train_step(spark: SparkSession, sf: str) -> DataFrame:
    texts = _written_texts(spark, sf)
    vocab, weights = _written_vocabulary(spark, sf, texts)
    vocab, weights = embedding.train_step(texts, vocab, weights, RATE, CONTEXT, LENGTH)
    return _long(vocab, "id").withColumn("side", F.lit("x")).unionByName(
        _long(weights, "id").withColumn("side", F.lit("w"))
    )


QUERIES: dict[str, Query] = {
    "log_parse": log_parse,
    "log_bad_lines": log_bad_lines,
    "log_parse_report": log_parse_report,
    "log_text_scan": log_text_scan,
    "log_size_stats": log_size_stats,
    "log_status_counts": _on_logs(logs.status_counts),
    "log_busy_hosts": _on_logs(lambda rows: logs.busy_hosts(rows, k=None)),
    "log_busy_hosts_20": _on_logs(logs.busy_hosts),
    "log_top_endpoints": _on_logs(logs.top_endpoints),
    "log_top_failed_endpoints": _on_logs(logs.top_failed_endpoints),
    "log_unique_hosts": _on_logs(logs.unique_hosts),
    "log_daily_hosts": _on_logs(logs.daily_hosts),
    "log_weekly_sketches": log_weekly_sketches,
    "log_daily_avg_requests": _on_logs(logs.daily_requests_per_host),
    "log_404_count": _on_logs(lambda rows: logs.row_count(logs.not_found(rows))),
    "log_404_endpoints": _on_logs(logs.not_found_endpoints),
    "log_404_top_endpoints": _on_logs(logs.not_found_top_endpoints),
    "log_404_top_hosts": _on_logs(logs.not_found_top_hosts),
    "log_404_by_day": _on_logs(logs.not_found_by_day),
    "log_404_top_days": _on_logs(logs.not_found_top_days),
    "log_404_by_hour": _on_logs(logs.not_found_by_hour),
    "rel_distinct": lambda spark, sf: relational.distinct_values(views.ballots(spark, sf), "candidate_name"),
    "rel_ballot_order": lambda spark, sf: relational.ballot_order(views.ballots(spark, sf)),
    "rel_lookup_join": rel_friendly_order,
    "rel_total_sum": rel_total_sum,
    "rel_sum_all": rel_sum_all,
    "rel_json_head": rel_json_head,
    "rel_sum_by_key": lambda spark, sf: relational.total_by(
        views.ballots(spark, sf), "candidate_name", "total_votes"
    ),
    "rel_top_valid_group": lambda spark, sf: relational.top_valid_group(
        views.ballots(spark, sf), "precinct_code", "precinct_name", "total_votes"
    ),
    "rel_json_roundtrip": rel_json_roundtrip,
    "rel_json_scan": rel_json_scan,
    "rel_json_variant": rel_json_variant,
    "graph_default_vertices": lambda spark, sf: views.partly_known_graph(spark, sf).vertices,
    "graph_vertex_filter": _on_graph(lambda g: g.vertices.filter("age >= 30").select("name", "age")),
    "graph_triplets": _on_graph(_flat_triplets),
    "graph_strong_edges": _on_graph(lambda g: _flat_triplets(g).filter("attr > 5")),
    "graph_in_degrees": _on_graph(graph.in_degrees),
    "graph_out_degrees": _on_graph(graph.out_degrees),
    "graph_degrees": _on_graph(lambda g: graph.with_degrees(g).vertices),
    "graph_equal_degree": _on_graph(lambda g: graph.equal_degrees(g).select("id", "name")),
    "graph_oldest_follower": _on_graph(graph.oldest_follower_sentences),
    "graph_two_rounds": graph_two_rounds,
    "graph_avg_follower_age": graph_avg_follower_age,
    "graph_messages_both_ways": _on_graph(_both_ways),
    "graph_map_and_join": _on_graph(_renamed),
    "graph_subgraph": _on_graph(_adult_edges),
    "graph_components": _on_graph(lambda g: connected_components(_adults(g))),
    "graph_without_edges": graph_without_edges,
    "tags_enrich": tags_enrich,
    "tags_similar_pairs": tags_similar_pairs,
    "tags_similar_graph": tags_similar_graph,
    "tags_similar_sets": tags_similar_sets,
    "tags_set_members": tags_set_members,
    "tags_link_counts": tags_link_counts,
    "tags_set_graph": tags_set_graph,
    "graph_hops": graph_hops,
    "graph_cheapest": graph_cheapest,
    "graph_pic": graph_pic,
    "graph_pic_ids": graph_pic_ids,
    "vec_nearest": vec_nearest,
    "vec_nearest_batch": vec_nearest_batch,
    "vec_nearest_indexed": vec_nearest_indexed,
    "vec_requests": vec_requests,
    "stream_running_avg": stream_running_avg,
    "stream_running_avg_trace": stream_running_avg_trace,
    "stream_feed_means": stream_feed_means,
    "keyed_upsert": keyed_upsert,
    "keyed_lookup": keyed_lookup,
    "stream_train_metrics": stream_train_metrics,
    "stream_train_vocab": stream_train_vocab,
    "stream_train_weights": stream_train_weights,
    "stream_train_restored": stream_train_restored,
    "text_tokens": text_tokens,
    "text_digits": text_digits,
    "text_new_words": text_new_words,
    "text_new_words_filtered": text_new_words_filtered,
    "contender_counts": contender_counts,
    "contender_decay": contender_decay,
    "vocab_admission": vocab_admission,
    "emb_context": emb_context,
    "emb_softmax": emb_softmax,
    "emb_gradients": emb_gradients,
    "emb_train_step": emb_train_step,
}
