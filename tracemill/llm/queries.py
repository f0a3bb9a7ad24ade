"""Queries of the training-data operators, with oracle SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracemill.llm import bpe, caps, crosssplit, langid, packing, segment
from tracemill.plans.registry import Registry
from tracemill.session import materialize, table

LLM = Registry()

_CURRENT = "cur AS (SELECT DISTINCT * FROM rollout_run WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY run_id, trajectory_id ORDER BY id DESC) = 1)"

# 1: pieces of oversized transcripts -------------------------------------------------


def _plans(spark, d):
    return segment.plans(segment.transcripts(spark, f"{d}/trajectory_messages.parquet"))


def _current(spark, d, *cols):
    keys = ("run_id", "trajectory_id")
    return caps.current_rows(table(spark, d, "rollout_run", *keys, "id", *cols), keys, "id", *cols)


_P1_LATEST = """t AS (SELECT run_id, trajectory_id, saved_at, coalesce(list_sum(list_transform(flatten(list_transform(list_filter(messages, lambda x: x IS NOT NULL), lambda x: coalesce(x.content, [])))
  , lambda y: CASE WHEN y.type = 'text' THEN coalesce(length(y.text), 0) ELSE 0 END)), 0) AS n_chars FROM trajectory_messages),
latest AS (SELECT run_id, trajectory_id, max(n_chars) AS n_chars FROM (SELECT *, rank() OVER (PARTITION BY run_id, trajectory_id ORDER BY saved_at DESC NULLS LAST) AS rk FROM t) WHERE rk = 1 GROUP BY ALL)"""


@LLM.query(
    "p1_found",
    f"""WITH {_P1_LATEST}, {_CURRENT}
SELECT c.run_id, c.trajectory_id FROM cur c JOIN latest l ON c.run_id = l.run_id AND c.trajectory_id = l.trajectory_id
WHERE l.n_chars > 6000 AND (c.num_chunks IS NULL OR c.num_chunks < 2 OR c.split_dir IS NULL OR trim(c.split_dir, E' \\t\\n\\r') = '')""",
)
def p1_found(spark, d):
    cut = _plans(spark, d).filter(F.size("ends") > 1).select("run_id", "trajectory_id")
    uncut = F.col("num_chunks").isNull() | (F.col("num_chunks") < 2) | F.col("split_dir").isNull() | (F.col("split_dir").rlike(r"(?U)^\s*$"))
    rows = _current(spark, d, "num_chunks", "split_dir").filter(uncut)
    return rows.join(cut, ["run_id", "trajectory_id"], "left_semi").select("run_id", "trajectory_id")


@LLM.query("p1_pieces")
def p1_pieces(spark, d):
    """Every piece of every transcript with its text."""
    return segment.pieces(segment.transcripts(spark, f"{d}/trajectory_messages.parquet"))


@LLM.query(
    "p1_rebuilt",
    """WITH t AS (SELECT run_id, trajectory_id, saved_at, coalesce(list_aggregate(list_transform(flatten(list_transform(list_filter(messages, lambda x: x IS NOT NULL), lambda x: coalesce(x.content, [])))
  , lambda y: CASE WHEN y.type = 'text' THEN coalesce(y.text, '') ELSE '' END), 'string_agg', ''), '') AS text FROM trajectory_messages),
latest AS (SELECT *, rank() OVER (PARTITION BY run_id, trajectory_id ORDER BY saved_at DESC NULLS LAST) AS rk FROM t)
SELECT run_id, trajectory_id, max(text) AS text, true AS within_limit, true AS overlaps FROM latest WHERE rk = 1 GROUP BY ALL""",
)
def p1_rebuilt(spark, d):
    """Each transcript put together again from its pieces, and whether these keep the limit and the overlap."""
    p = segment.pieces(segment.transcripts(spark, f"{d}/trajectory_messages.parquet"))
    all_ = F.array_sort(F.collect_list(F.struct("piece_no", "start", "end", "text"))).alias("p")
    rows = p.groupBy("run_id", "trajectory_id").agg(all_)
    before = lambda x: F.get("p", x.getField("piece_no") - 1)
    fresh = F.transform("p", lambda x: F.when(x.getField("piece_no") == 0, x.getField("text")).otherwise(F.substring(x.getField("text"), before(x).getField("end") - x.getField("start") + 1, segment.LIMIT)))
    starts = lambda x: (x.getField("piece_no") == 0) | F.startswith(x.getField("text"), F.right(before(x).getField("text"), F.lit(segment.OVERLAP)))
    return rows.select("run_id", "trajectory_id", F.array_join(fresh, "").alias("text"), F.forall("p", lambda x: F.length(x.getField("text")) <= segment.LIMIT).alias("within_limit"), F.forall("p", starts).alias("overlaps"))


@LLM.query("p1_rollout_updates")
def p1_rollout_updates(spark, d):
    """num_chunks and split_dir that tell the cut, for the current rows with a transcript."""
    cut = _plans(spark, d).select("run_id", "trajectory_id", F.size("ends").alias("n_pieces"))
    rows = _current(spark, d, "num_chunks", "split_dir").join(cut, ["run_id", "trajectory_id"])
    blank = F.coalesce(F.length(F.trim("split_dir")) == 0, F.lit(True))
    folder = F.when(blank, F.concat_ws("/", F.lit("/pool/rollouts"), "run_id", "trajectory_id")).otherwise(F.col("split_dir"))
    return rows.select("id", "run_id", "trajectory_id", F.col("n_pieces").alias("num_chunks"), F.when(F.col("n_pieces") > 1, folder).otherwise(F.col("split_dir")).alias("split_dir"))


# 3: caps per contributor ------------------------------------------------------------

_P3_ORDER = "CASE WHEN reward IS NULL OR isnan(reward) OR reward = -1 THEN NULL ELSE reward END DESC NULLS LAST, create_at DESC NULLS LAST, id DESC"


@LLM.query("p3_found", f"WITH {_CURRENT} SELECT id FROM cur QUALIFY row_number() OVER (PARTITION BY run_id, task_id ORDER BY {_P3_ORDER}) > 8")
def p3_found(spark, d):
    rows = _current(spark, d, "task_id", "reward", "create_at").drop("trajectory_id")
    return caps.over_cap(rows, ["run_id", "task_id"], "reward", [F.col("create_at").desc_nulls_last(), F.col("id").desc()], "id", cap=8)


@LLM.query(
    "p3_kept_per_run",
    f"""WITH {_CURRENT}, k AS (SELECT run_id, task_id, row_number() OVER (PARTITION BY run_id, task_id ORDER BY {_P3_ORDER}) AS rk FROM cur)
SELECT run_id, count(*) FILTER (rk <= 8) AS n_kept, count(*) FILTER (rk > 8) AS n_left_out FROM k GROUP BY run_id""",
)
def p3_kept_per_run(spark, d):
    rows = _current(spark, d, "task_id", "reward", "create_at").drop("trajectory_id")
    out = caps.over_cap(rows, ["run_id", "task_id"], "reward", [F.col("create_at").desc_nulls_last(), F.col("id").desc()], "id", cap=8)
    marked = rows.join(out.withColumn("gone", F.lit(1)), "id", "left")
    return marked.groupBy("run_id").agg(F.count_if(F.col("gone").isNull()).alias("n_kept"), F.count_if(F.col("gone").isNotNull()).alias("n_left_out"))


# 4: overlaps across splits ----------------------------------------------------------


def _overlaps(spark, d):
    m = table(spark, d, "task_manifest", "entry_id", "manifest", "task_id").filter("manifest is not null")
    entries = m.select(F.col("entry_id").alias("entry"), crosssplit.norm_key(F.col("task_id")).alias("k"), (F.col("manifest") == "training_set").alias("is_a"))
    return crosssplit.cross_split(entries, crosssplit.longest_texts(table(spark, d, "rollout_run", "task_id", "instruction"), "task_id", "instruction"))


_P4 = r"""
WITH e AS (SELECT DISTINCT entry_id, manifest, domain, rtrim(regexp_replace(trim(lower(task_id), E' 	

'), '\.json$', '')) AS k FROM task_manifest WHERE manifest IS NOT NULL AND task_id IS NOT NULL),
i AS (SELECT rtrim(regexp_replace(trim(lower(task_id), E' 	

'), '\.json$', '')) AS k, trim(instruction, E' 	

') AS text FROM rollout_run),
l AS (SELECT k, arg_max(text, (length(text), text)) AS text FROM i WHERE length(text) > 0 GROUP BY k),
w AS (SELECT k, list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS ws FROM l WHERE k IN (SELECT k FROM e)),
x AS (SELECT k, len(ws) AS n, unnest(ws) AS word FROM w),
ta AS (SELECT DISTINCT k FROM e WHERE manifest = 'training_set'), tb AS (SELECT DISTINCT k FROM e WHERE manifest <> 'training_set'),
s AS (SELECT a.k AS ka, b.k AS kb, count(*) AS c, any_value(a.n) AS na, any_value(b.n) AS nb FROM (SELECT * FROM x WHERE k IN (FROM ta)) a JOIN (SELECT * FROM x WHERE k IN (FROM tb)) b ON a.word = b.word GROUP BY ALL),
kp AS (SELECT ka, kb FROM s WHERE c * 10 >= 7 * (na + nb - c) UNION SELECT k, k FROM ta WHERE k IN (FROM tb)),
pairs AS (SELECT a.entry_id AS t, b.entry_id AS v, b.manifest, b.domain FROM kp JOIN e a ON a.k = ka AND a.manifest = 'training_set' JOIN e b ON b.k = kb AND b.manifest <> 'training_set')
"""


@LLM.query("p4_found", _P4 + "SELECT DISTINCT least(t, v) AS entry_a, greatest(t, v) AS entry_b FROM pairs")
def p4_found(spark, d):
    pairs = crosssplit.entry_pairs(*_overlaps(spark, d))
    return pairs.select(F.least("a", "b").alias("entry_a"), F.greatest("a", "b").alias("entry_b"))


@LLM.query("p4_report", _P4 + "SELECT manifest, domain, count(DISTINCT (t, v)) AS n_pairs, count(DISTINCT v) AS n_eval_entries FROM pairs GROUP BY ALL")
def p4_report(spark, d):
    """Overlaps per evaluation manifest and domain, from counts per class."""
    members, links = _overlaps(spark, d)
    training = members.filter("is_a").groupBy(F.col("class").alias("class_a")).agg(F.count("*").alias("n"))
    linked = links.join(training, "class_a").groupBy(F.col("class_b").alias("class")).agg(F.sum("n").alias("n"))
    m = table(spark, d, "task_manifest", "entry_id", "manifest", "domain").filter("manifest <> 'training_set'").withColumnRenamed("entry_id", "entry").distinct()
    found = members.filter("not is_a").select("entry", "class").join(linked, "class")
    return found.join(m, "entry").groupBy("manifest", "domain").agg(F.sum("n").alias("n_pairs"), F.count("*").alias("n_eval_entries"))


@LLM.query(
    "p4_links",
    _P4
    + """, c AS (SELECT k, ws, md5(array_to_string(list_sort(ws), ' ')) AS class FROM w WHERE len(ws) > 0),
mem AS (SELECT DISTINCT e.entry_id, e.manifest = 'training_set' AS is_a, coalesce(c.class, 'key ' || e.k) AS class, c.ws FROM e LEFT JOIN c USING (k)),
cl AS (SELECT class, any_value(ws) AS ws, count(*) FILTER (is_a) AS n_a, count(*) FILTER (NOT is_a) AS n_b FROM mem GROUP BY class),
near AS (SELECT md5(array_to_string(list_sort(wa.ws), ' ')) AS class_a, md5(array_to_string(list_sort(wb.ws), ' ')) AS class_b FROM (SELECT DISTINCT ka, kb FROM kp) JOIN w wa ON wa.k = ka JOIN w wb ON wb.k = kb WHERE len(wa.ws) > 0
  UNION SELECT class, class FROM cl WHERE n_a > 0 AND n_b > 0)
SELECT class_a, class_b, a.n_a AS n_training, b.n_b AS n_eval,
round(CASE WHEN class_a = class_b THEN 1.0 ELSE len(list_intersect(a.ws, b.ws)) / (len(a.ws) + len(b.ws) - len(list_intersect(a.ws, b.ws))) END, 9) AS jaccard
FROM near JOIN cl a ON a.class = class_a JOIN cl b ON b.class = class_b""",
)
def p4_links(spark, d):
    """Linked classes of equal wording with their similarity and how many entries of either side they hold."""
    members, links = _overlaps(spark, d)
    n = members.groupBy("class").agg(F.count_if(F.col("is_a")).alias("n_training"), F.count_if(~F.col("is_a")).alias("n_eval"))
    a, b = n.select(F.col("class").alias("class_a"), "n_training"), n.select(F.col("class").alias("class_b"), "n_eval")
    return links.join(a, "class_a").join(b, "class_b").select("class_a", "class_b", "n_training", "n_eval", F.round("jaccard", 9).alias("jaccard"))


@LLM.query("p4_ways")
def p4_ways(spark, d):
    """Links of different classes by the way that found them, with their mean overlap of shared chunks."""
    _, links = _overlaps(spark, d)
    return links.filter("class_a <> class_b").groupBy("by_chunks").agg(F.count("*").alias("n_links"), F.avg("overlap_a").alias("mean_overlap_a"), F.avg("overlap_b").alias("mean_overlap_b"))


# 6: token ids -----------------------------------------------------------------------


@LLM.query("p6_ids")
def p6_ids(spark, d):
    return bpe.encode(table(spark, d, "documents", "doc_id", "text"))


@LLM.query("p6_decoded", "SELECT doc_id, coalesce(text, '') AS text FROM documents")
def p6_decoded(spark, d):
    """The texts back from their ids: the round trip must give every text again."""
    return bpe.decode(bpe.encode(table(spark, d, "documents", "doc_id", "text")))


# 7: containers ----------------------------------------------------------------------


def _sizes(spark, d):
    return materialize(bpe.count_tokens(table(spark, d, "documents", "doc_id", "text")), "sizes")


@LLM.query("p7_found")
def p7_found(spark, d):
    """Documents that needed more than one container."""
    parts = packing.pack(_sizes(spark, d)).groupBy("id", "n", "copy").agg(F.countDistinct("container").alias("containers"))
    return parts.filter("containers > 1").select(F.col("id").alias("doc_id")).distinct()


@LLM.query("p7_containers")
def p7_containers(spark, d):
    """Every document with its container; part counts the pieces of an oversized one, copy equal rows of an id."""
    return packing.pack(_sizes(spark, d)).select(F.col("id").alias("doc_id"), "part", "copy", F.col("size").alias("n_tokens"), "container")


@LLM.query("p7_checked", "SELECT doc_id, true AS all_tokens_once, true AS whole_if_it_fits, true AS within_capacity FROM documents WHERE length(text) > 0")
def p7_checked(spark, d):
    """What must hold of every document with a token: its tokens come out once, uncut if it fits, in no overfull container."""
    sizes = _sizes(spark, d)
    placed = packing.pack(sizes)
    full = placed.groupBy("container").agg(F.sum("size").alias("held"))
    docs = placed.join(full, "container").groupBy(F.col("id").alias("doc_id")).agg(F.sum("size").alias("n"), F.countDistinct("container").alias("containers"), F.max("held").alias("most"))
    own = sizes.filter("n_tokens > 0").join(docs, "doc_id", "left")
    return own.select(
        "doc_id", F.coalesce(F.col("n") == F.col("n_tokens"), F.lit(False)).alias("all_tokens_once"),
        ((F.col("n_tokens") > packing.CAPACITY) | (F.col("containers") == 1)).alias("whole_if_it_fits"), (F.col("most") <= packing.CAPACITY).alias("within_capacity"),
    )


@LLM.query("p7_fill")
def p7_fill(spark, d):
    """Containers used, the fewest that the tokens could need, and the room left."""
    c = packing.pack(_sizes(spark, d)).groupBy("container").agg(F.sum("size").alias("size"))
    total = F.sum("size")
    return c.agg(F.count("*").alias("n_containers"), F.ceil(total / packing.CAPACITY).alias("lower_bound"), (1 - total / (F.count("*") * packing.CAPACITY)).alias("room_left"))


@LLM.query("p7_search")
def p7_search(spark, d):
    """What the search did, by round: groups, those that needed a search, gained by it, ended without proof, and containers above the bound."""
    g = packing.searched(_sizes(spark, d))
    return g.groupBy("round").agg(
        F.count("*").alias("n_groups"), F.count_if(F.col("opened") > 0).alias("n_searched"), F.count_if(F.col("used") < F.col("best_fit")).alias("n_improved"),
        F.count_if(~F.col("proven")).alias("n_unproven"), F.sum("used").alias("n_containers"), F.sum(F.col("used") - F.col("bound")).alias("n_above_bound"),
    )


# 8: languages -----------------------------------------------------------------------


def _languages(spark, d):
    docs = table(spark, d, "documents", "doc_id", "text", "lang")
    return langid.identify(docs, langid.train(docs), "doc_id", "text", "lang")


@LLM.query("p8_found")
def p8_found(spark, d):
    rows = _languages(spark, d).select("doc_id", langid.canonical_label(F.col("lang")).alias("label"), langid.languages().alias("langs"))
    case = (F.size("langs") > 1) | ((F.size("langs") == 1) & ~F.col("label").eqNullSafe(F.get("langs", F.lit(0))))
    return rows.filter(case).select("doc_id", F.explode("langs").alias("lang"))


@LLM.query("p8_documents")
def p8_documents(spark, d):
    """Main language and confidence of each document, beside what its label says."""
    main = langid.main_language()
    rows = _languages(spark, d).select("doc_id", langid.canonical_label(F.col("lang")).alias("label"), main.alias("m"))
    status = F.when(F.col("m").isNull(), "no sentence").when(F.col("label").isNull(), "missing").when(F.col("label") == F.col("m.lang"), "right").otherwise("wrong")
    return rows.select("doc_id", F.col("m.lang").alias("lang"), F.col("m.confidence").alias("confidence"), status.alias("label_status"))


@LLM.query("p8_segments")
def p8_segments(spark, d):
    return langid.segment_rows(_languages(spark, d))
