"""Queries on transcripts, windows, balancing, files and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracemill.functions import text
from tracemill.operators import balance, batch, metrics
from tracemill.operators import trajectory as tr
from tracemill.plans.adapters import CATALOG, catalog
from tracemill.plans.registry import CORE
from tracemill.session import materialize, shared_dir, table
from tracemill.sources import readers, recipes, writers
from tracemill.streaming import monitor

# transcripts: the latest save of each, without null messages -------------------------------

_M = """m AS (SELECT run_id, trajectory_id, list_filter(messages, lambda x: x IS NOT NULL AND x.content IS NOT NULL) AS msgs FROM (SELECT *, row_number() OVER (PARTITION BY run_id, trajectory_id ORDER BY saved_at DESC NULLS LAST) AS rk FROM trajectory_messages) WHERE rk = 1 AND messages IS NOT NULL)"""
_KEY = ["run_id", "trajectory_id"]


def _messages(s, d):
    src = table(s, d, "trajectory_messages", *_KEY, "messages", "saved_at")
    # messages of equal saves are equal; times only decide, so one number per key and save is compared
    last = src.groupBy(*_KEY).agg(F.max("saved_at").alias("saved_at"))
    one = src.join(last, [*_KEY, "saved_at"]).dropDuplicates(_KEY).filter("messages is not null")
    return one.select(*_KEY, F.filter("messages", lambda m: m.isNotNull() & m["content"].isNotNull()).alias("msgs"))


def _sizes(w: str = "window"):
    return [F.size(w).alias("n_messages"), F.coalesce(F.aggregate(F.transform(w, tr.n_images), F.lit(0), lambda s, x: s + x), F.lit(0)).alias("n_images")]


_IMG = "list_sum(list_transform({0}, lambda x: len(list_filter(x.content, lambda c: c.type = 'image'))))"
CORE.query(
    "stepwise_windows",
    f"""WITH {_M}, e AS (SELECT run_id, trajectory_id, msgs, unnest(range(3, len(msgs), 2)) AS step_end FROM m),
w AS (SELECT *, greatest(0, step_end - 2 * 3 - 1) AS window_start FROM e)
SELECT run_id, trajectory_id, CAST(step_end AS INTEGER) AS step_end, CAST(window_start AS INTEGER) AS window_start, CAST(step_end - window_start + CASE WHEN window_start > 0 THEN 2 ELSE 0 END AS INTEGER) AS n_messages FROM w""",
)(lambda s, d: tr.stepwise(_messages(s, d), "msgs", 3).select(*_KEY, "step_end", "window_start", F.size("window").alias("n_messages")))
CORE.query(
    "image_limited_windows",
    f"""WITH {_M}, p AS (SELECT run_id, trajectory_id, msgs, unnest(range(1, len(msgs) + 1)) AS i FROM m), c AS (SELECT run_id, trajectory_id, i, len(msgs[i].content) AS items, len(list_filter(msgs[i].content, lambda c: c.type = 'image')) AS n FROM p),
r AS (SELECT *, sum(n) OVER (PARTITION BY run_id, trajectory_id ORDER BY i DESC) AS tail, sum(n) OVER (PARTITION BY run_id, trajectory_id) AS total FROM c),
k AS (SELECT *, CASE WHEN tail > 2 AND total > 2 THEN 0 ELSE n END AS kept, CASE WHEN tail > 2 AND total > 2 THEN items - n ELSE items END AS left_items FROM r)
SELECT run_id, trajectory_id, CAST(count(*) FILTER (total <= 2 OR left_items > 0) AS INTEGER) AS n_messages, CAST(sum(kept) AS INTEGER) AS n_images FROM k GROUP BY run_id, trajectory_id""",
)(lambda s, d: _messages(s, d).filter("size(msgs) > 0").select(*_KEY, tr.limit_images(F.col("msgs"), 2).alias("window")).select(*_KEY, *_sizes()))
CORE.query(
    "sliding_windows",
    f"""WITH {_M}, e AS (SELECT run_id, trajectory_id, msgs, unnest(range(1, len(msgs) + 2 - 6, 4)) AS s FROM m WHERE len(msgs) >= 3),
w AS (SELECT *, (s - 1) / 4 AS k FROM e)
SELECT run_id, trajectory_id, CAST(k AS INTEGER) AS chunk_index, CAST(s AS INTEGER) AS window_start,
 CAST(2 + len(list_filter(msgs[greatest(s - 10, 0) + 1:s], lambda x: x.role = 'assistant')) + least(6, len(msgs) - s) - CASE WHEN k = 0 THEN 1 ELSE 0 END AS INTEGER) AS n_messages FROM w""",
)(lambda s, d: tr.sliding(_messages(s, d), "msgs", 3, 2, 5).select(*_KEY, "chunk_index", "window_start", F.size("window").alias("n_messages")))
CORE.query(
    "chunk_manifest",
    f"WITH {_M}, e AS (SELECT trajectory_id, unnest(range(1, len(msgs) + 2 - 6, 4)) AS s FROM m WHERE len(msgs) >= 3) SELECT trajectory_id, CAST(count(*) AS INTEGER) AS num_chunks FROM e GROUP BY trajectory_id",
)(lambda s, d: _chunk_files(s, d))


def _chunk_files(s, d):
    windows = tr.sliding(_messages(s, d), "msgs", 3, 2, 5).select("trajectory_id", "chunk_index", "window")
    return writers.chunks(windows, _folder(s, "chunks")).drop("split_dir")


CORE.query(
    "assistant_step_texts",
    f"""WITH {_M}, a AS (SELECT run_id, trajectory_id, list_filter(msgs, lambda x: x.role = 'assistant') AS am FROM m), e AS (SELECT run_id, trajectory_id, am, unnest(range(len(am))) AS ordinal FROM a)
SELECT run_id, trajectory_id, CAST(ordinal AS INTEGER) AS ordinal, md5(array_to_string(list_transform(list_filter(am[ordinal + 1].content, lambda c: c.type = 'text'), lambda c: coalesce(c.text, '')), '')) AS digest FROM e""",
)(lambda s, d: tr.step_texts(_messages(s, d), "msgs").select(*_KEY, "ordinal", F.md5("text").alias("digest")))
CORE.query(
    "step_logp_alignment",
    f"""WITH {_M}, a AS (SELECT run_id, trajectory_id, len(list_filter(msgs, lambda x: x.role = 'assistant')) AS n FROM m), e AS (SELECT run_id, trajectory_id, unnest(range(n)) AS ordinal FROM a) SELECT run_id, trajectory_id, CAST(ordinal AS INTEGER) AS ordinal FROM e WHERE ordinal % 2 = 0""",
)(lambda s, d: _aligned(s, d))


def _aligned(s, d):
    steps = tr.step_texts(_messages(s, d), "msgs").select(*_KEY, "ordinal").withColumn("key", F.concat_ws("|", *_KEY))
    logps = steps.filter("ordinal % 2 = 0").select("key", "ordinal", F.lit(-0.5).alias("logp"))
    return tr.align_logps(steps, logps, "key").select(*_KEY, "ordinal")


CORE.query(
    "image_url_renamed",
    f"WITH {_M}, i AS (SELECT run_id, trajectory_id, unnest(flatten(list_transform(msgs, lambda x: x.content))) AS c FROM m) SELECT CASE WHEN c.type = 'image_url' THEN 'image' ELSE c.type END AS type, count(*) AS n FROM i WHERE c IS NOT NULL GROUP BY 1",
)(lambda s, d: _messages(s, d).select(F.explode(F.flatten(F.transform("msgs", lambda m: text.rename_image_items(m["content"])))).alias("c")).filter("c.type is not null").groupBy("c.type").agg(F.count("*").alias("n")))
CORE.query("messages_per_role", f"WITH {_M}, i AS (SELECT unnest(msgs) AS x FROM m) SELECT x.role AS role, count(*) AS n FROM i GROUP BY 1")(lambda s, d: _messages(s, d).select(F.explode("msgs").alias("x")).groupBy(F.col("x.role").alias("role")).agg(F.count("*").alias("n")))
CORE.query(
    "conversation_loss_mask",
    f"""WITH {_M}, l AS (SELECT run_id, trajectory_id, list_transform(msgs, lambda x: CASE WHEN x.role = 'assistant' THEN greatest(len(x.content) - 1, 0) ELSE 0 END) AS ones, list_transform(msgs, lambda x: len(x.content)) AS n FROM m WHERE len(msgs) > 0)
SELECT run_id, trajectory_id, CAST(list_sum(n) AS INTEGER) AS n_tokens, CAST(list_sum(ones) AS INTEGER) AS n_ones FROM l""",
)(lambda s, d: _masked(_messages(s, d).filter("size(msgs) > 0")))


def _masked(m):
    """Each item of content stands for a token; the first one of a message is its generation prompt."""
    mask = tr.loss_mask(F.transform("msgs", lambda x: x["role"]), F.transform("msgs", lambda x: F.size(x["content"])), F.transform("msgs", lambda x: F.lit(1)))
    return m.select(*_KEY, mask.alias("k")).select(*_KEY, F.size("k").alias("n_tokens"), F.aggregate("k", F.lit(0), lambda s, x: s + x).alias("n_ones"))


_P = "p AS (SELECT n_nationkey AS n FROM nation)"
# places at growing distance, then, where they coincide, the newest of the others
CORE.query(
    "log_spaced_history",
    f"""WITH {_P}, f AS (SELECT DISTINCT n, greatest(least(n - 1 - CAST(round_even(exp(j * ln(n) / 4) - 1, 0) AS INTEGER), n - 1), 0) AS x FROM p, (SELECT unnest([0, 1, 2, 3, 4]) AS j) WHERE n > 5),
r AS (SELECT p.n, i.x, row_number() OVER (PARTITION BY p.n ORDER BY i.x DESC) AS k FROM p, range(1000) i(x) WHERE p.n > 5 AND i.x < p.n AND NOT EXISTS (SELECT 1 FROM f WHERE f.n = p.n AND f.x = i.x)),
a AS (SELECT n, x FROM f UNION ALL SELECT n, x FROM r WHERE k <= 5 - (SELECT count(*) FROM f WHERE f.n = r.n))
SELECT n, CASE WHEN n <= 5 THEN array_to_string(range(n), ',') ELSE (SELECT string_agg(CAST(x AS VARCHAR), ',' ORDER BY x) FROM a WHERE a.n = p.n) END AS kept FROM p""",
)(
    lambda s, d: table(s, d, "nation", F.col("n_nationkey").alias("n")).select("n", F.array_join(tr.log_spaced(F.col("n"), 5), ",").alias("kept"))
)
CORE.query("equally_spaced_images", f"WITH {_P} SELECT n, CASE WHEN n <= 4 THEN array_to_string(range(n), ',') ELSE array_to_string(list_transform(range(4), lambda i: CAST(round_even(i * (n - 1) / 3.0, 0) AS INTEGER)), ',') END AS places FROM p")(
    lambda s, d: table(s, d, "nation", F.col("n_nationkey").alias("n")).select("n", F.array_join(tr.spaced_places(F.col("n"), 4), ",").alias("places"))
)
CORE.query("fitted_logps", f"WITH {_P} SELECT n, CASE WHEN n % 2 = 0 THEN array_to_string(list_transform(range(4), lambda i: CASE WHEN i < n THEN '-1.0' ELSE '0.0' END), ',') ELSE '0.0,0.0,0.0,0.0' END AS logps FROM p")(
    lambda s, d: table(s, d, "nation", F.col("n_nationkey").alias("n")).select("n", F.array_join(tr.fit_logps(F.array_repeat(F.lit(-1.0), F.col("n")), F.col("n") + F.col("n") % 2, 4), ",").alias("logps"))
)

# balancing ------------------------------------------------------------------------------------


def _lengths(s, d):
    """Line items of 256 orders, about a thousand, are one batch, whatever the size of the table."""
    return table(s, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity").select(F.floor(F.col("l_orderkey") / 256).alias("batch"), F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("row"), F.col("l_quantity").cast("long").alias("length"))


_LEN = "l AS (SELECT CAST(floor(l_orderkey / 256) AS BIGINT) AS batch, CAST(l_quantity AS BIGINT) AS length FROM lineitem)"
_PARTS = f"WITH {_LEN} SELECT batch, count(*) AS n_rows, true AS each_row_once"


def _parts(s, d, method="karmarkar_karp", **options):
    """Per batch: rows, whether each is in one part, and the rows of the greatest and the smallest part."""
    own = _lengths(s, d)
    parts = balance.partition(own, "batch", "row", "length", 8, method=method, **options)
    per = parts.groupBy("batch", "part").agg(F.count("*").alias("n"), F.sum("length").alias("s"))
    once = parts.groupBy("batch", "row").agg(F.count("*").alias("c")).groupBy("batch").agg(F.sum("c").alias("rows"), F.count("*").alias("ids"))
    sizes = per.groupBy("batch").agg(F.max("n").alias("most"), F.when(F.count("*") == 8, F.min("n")).otherwise(0).alias("least"))
    want = own.groupBy("batch").agg(F.count("*").alias("n"), F.countDistinct("row").alias("ids"))
    found = want.join(sizes, "batch", "left").join(once.withColumnRenamed("ids", "found"), "batch", "left")
    return found.withColumn("each_row_once", F.coalesce((F.col("rows") == F.col("n")) & (F.col("found") == F.col("ids")), F.lit(False)))


CORE.query("balanced_partition_sizes", f"{_PARTS}, CAST(ceil(count(*) / 8) AS BIGINT) AS largest_part FROM l GROUP BY batch")(
    lambda s, d: _parts(s, d).select("batch", F.col("n").alias("n_rows"), "each_row_once", F.col("most").alias("largest_part"))
)
CORE.query("balanced_partitions_checked", f"{_PARTS}, true AS within_one_row FROM l GROUP BY batch")(
    lambda s, d: _parts(s, d).select("batch", F.col("n").alias("n_rows"), "each_row_once", (F.col("most") - F.col("least") <= 1).alias("within_one_row"))
)
CORE.query("balanced_order", f"WITH {_LEN}, n AS (SELECT batch, count(*) AS n FROM l GROUP BY batch) SELECT batch, CAST(i AS BIGINT) AS place FROM n, range(2000) t(i) WHERE i < n")(
    lambda s, d: balance.partition(_lengths(s, d), "batch", "row", "length", 8).select("batch", F.col("place").cast("long").alias("place"))
)
CORE.query("greedy_partitions_checked", f"{_PARTS} FROM l GROUP BY batch")(lambda s, d: _parts(s, d, "greedy").select("batch", F.col("n").alias("n_rows"), "each_row_once"))
CORE.query("balanced_partitions")(lambda s, d: balance.partition(_lengths(s, d), "batch", "row", "length", 8))
CORE.query("greedy_partitions")(lambda s, d: balance.partition(_lengths(s, d), "batch", "row", "length", 8, method="greedy"))
CORE.query("balance_imbalance")(lambda s, d: metrics.imbalance(balance.partition(_lengths(s, d), "batch", "row", "length", 8), "part", "length", "batch", 8))
CORE.query("micro_batch_counts", f"WITH {_LEN} SELECT batch, CAST(ceil(sum(length) / 3000.0) AS BIGINT) AS n_parts, count(*) AS n_rows FROM l GROUP BY batch")(
    lambda s, d: balance.micro_batches(_lengths(s, d), "batch", "row", "length", 3000).groupBy("batch").agg(F.countDistinct("part").alias("n_parts"), F.count("*").alias("n_rows"))
)

# task files and manifests ----------------------------------------------------------------------

CORE.query("manifest_regrouped", "WITH r AS (SELECT manifest, domain, list_sort(list(task_id)) AS ids FROM task_manifest WHERE domain IS NOT NULL GROUP BY 1, 2) SELECT manifest, md5(string_agg(domain || ':' || array_to_string(ids, ','), ';' ORDER BY domain)) AS digest FROM r GROUP BY manifest")(
    lambda s, d: _regrouped(s, d)
)


def _regrouped(s, d):
    json = writers.regrouped(table(s, d, "task_manifest", "manifest", "domain", "task_id").filter("domain is not null"), "domain", "task_id", "manifest", name="tasks")
    m = json.withColumn("m", F.from_json("tasks", readers.MANIFEST))
    entries = F.array_sort(F.map_entries("m"))
    line = F.array_join(F.transform(entries, lambda e: F.concat_ws(":", e["key"], F.array_join(e["value"], ","))), ";")
    return m.select("manifest", F.md5(line).alias("digest"))


CORE.query("manifest_flattened", "SELECT domain AS task_type, task_id, count(*) AS n FROM task_manifest WHERE domain IS NOT NULL GROUP BY 1, 2")(
    lambda s, d: readers.manifest_rows(writers.regrouped(table(s, d, "task_manifest", "domain", "task_id").filter("domain is not null"), "domain", "task_id"), "manifest").groupBy("task_type", "task_id").agg(F.count("*").alias("n"))
)
CORE.query("feasible_tasks", "SELECT rec_no FROM task_config WHERE coalesce(evaluator.func, '') <> 'infeasible'")(lambda s, d: recipes.feasible(table(s, d, "task_config", "rec_no", F.col("evaluator.func").alias("func"))).select("rec_no"))
CORE.query("task_config_defaults", "SELECT rec_no, id AS task_id, 'ubuntu' AS os FROM task_config")(lambda s, d: recipes.with_defaults(table(s, d, "task_config", "rec_no", "id")).drop("id"))
_TK = "lower(trim(regexp_replace(trim({0}), '\\.json$', '')))"
CORE.query("task_config_joined", f"WITH c AS (SELECT {_TK.format('task_id')} AS k, max(snapshot) AS snapshot FROM task_config WHERE task_id IS NOT NULL GROUP BY 1) SELECT m.entry_id, c.snapshot FROM task_manifest m JOIN c ON {_TK.format('m.task_id')} = c.k")(lambda s, d: _configs(s, d, "inner"))
CORE.query("manifest_without_config", f"WITH c AS (SELECT DISTINCT {_TK.format('task_id')} AS k FROM task_config WHERE task_id IS NOT NULL) SELECT m.entry_id FROM task_manifest m WHERE m.task_id IS NOT NULL AND {_TK.format('m.task_id')} NOT IN (SELECT k FROM c)")(lambda s, d: _configs(s, d, "left_anti"))
CORE.query("allow_listed_tasks", "SELECT entry_id FROM task_manifest WHERE domain IN ('os', 'writer') AND task_id IN (SELECT task_id FROM task_manifest WHERE manifest = 'training_set')")(
    lambda s, d: (lambda m: recipes.allow_listed(m.filter("domain in ('os', 'writer')"), m.filter("manifest = 'training_set'"), "task_id").select("entry_id"))(table(s, d, "task_manifest"))
)


def _task_key(c):
    return F.lower(F.trim(F.regexp_replace(F.trim(c), r"\.json$", "")))


def _configs(s, d, how):
    c = table(s, d, "task_config", "task_id", "snapshot").filter("task_id is not null").groupBy(_task_key("task_id").alias("k")).agg(F.max("snapshot").alias("snapshot"))
    m = table(s, d, "task_manifest", "entry_id", "task_id").filter("task_id is not null").withColumn("k", _task_key("task_id"))
    return m.join(c, "k").select("entry_id", "snapshot") if how == "inner" else recipes.missing_files(m, c, "k").select("entry_id")


CORE.query(
    "valid_tasks_by_domain",
    "WITH j AS (SELECT coalesce(nullif(snapshot, ''), nullif(raw.task_type, ''), 'unknown') AS domain, coalesce(task_id, id) AS task_id FROM task_config) SELECT domain, count(DISTINCT task_id) AS n_tasks, count(*) FILTER (task_id IS NULL) AS n_skipped FROM j GROUP BY domain",
)(
    lambda s, d: table(s, d, "task_config", F.coalesce(F.nullif("snapshot", F.lit("")), F.nullif("raw.task_type", F.lit("")), F.lit("unknown")).alias("domain"), F.coalesce("task_id", "id").alias("task_id"))
    .groupBy("domain").agg(F.countDistinct("task_id").alias("n_tasks"), F.count_if(F.col("task_id").isNull()).alias("n_skipped"))
)
CORE.query("unfinished_tasks", f"WITH {CATALOG}, m AS (SELECT DISTINCT {_TK.format('task_id')} AS task_id FROM task_manifest WHERE task_id IS NOT NULL) SELECT task_id FROM m WHERE NOT EXISTS (SELECT 1 FROM cat WHERE reward IS NOT NULL AND starts_with(trajectory_id, m.task_id))")(
    lambda s, d: recipes.unfinished(
        table(s, d, "task_manifest", "task_id").filter("task_id is not null").select(_task_key("task_id").alias("task_id"), F.lit("t").alias("task_type")).distinct(),
        catalog(s, d).select(F.col("trajectory_id").alias("folder"), "reward", F.lit("t").alias("task_type")),
    ).select("task_id")
)
CORE.query("replayed_actions", "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 1 END AS n FROM orders")(lambda s, d: table(s, d, "orders", F.col("o_orderkey").alias("k")).select("k", recipes.action_count(F.when(F.col("k") % 2 == 0, "Thought: x\nAction: a()\nb()").otherwise("Action: c()\n")).alias("n")))

# preparation recipes -----------------------------------------------------------------------------

_OK = "SELECT o_orderkey AS k FROM orders"
CORE.query("recipe_gsm8k", f"SELECT k AS index, k || ' apples? Let''s think step by step and output the final answer after \"####\".' AS content, CAST(k AS VARCHAR) AS truth FROM ({_OK})")(lambda s, d: _flat(recipes.gsm8k(table(s, d, "orders", F.col("o_orderkey").alias("index")).withColumns({"question": F.concat(F.col("index").cast("string"), F.lit(" apples?")), "answer": F.concat(F.lit("so #### "), F.col("index").cast("string"))}), "train")))
CORE.query("recipe_math", f"SELECT k AS index, k || '? Let''s think step by step and output the final answer within \\boxed{{}}.' AS content, CAST(k AS VARCHAR) AS truth FROM ({_OK})")(
    lambda s, d: _flat(recipes.math(table(s, d, "orders", F.col("o_orderkey").alias("index")).withColumns({"problem": F.concat(F.col("index").cast("string"), F.lit("?")), "solution": F.concat(F.lit("it is \\boxed{"), F.col("index").cast("string"), F.lit("}"))}), "test"))
)


def _flat(df):
    return df.select(F.col("extra_info.index").alias("index"), F.col("prompt")[0]["content"].alias("content"), F.col("reward_model.ground_truth").alias("truth"))


CORE.query("recipe_hellaswag", f"SELECT k AS index, 'Go: a. Then' || k AS content, CAST(k % 4 AS INTEGER) AS truth, 'x' AS choice FROM ({_OK}) WHERE k % 3 > 0")(lambda s, d: _hellaswag(s, d))


def _hellaswag(s, d):
    k = F.col("index")
    src = table(s, d, "orders", F.col("o_orderkey").alias("index")).select("index", F.lit("Go").alias("activity_label"), F.lit("a.").alias("ctx_a"), F.concat(F.lit("then"), k.cast("string")).alias("ctx_b"), F.when(k % 3 > 0, (k % 4).cast("string")).otherwise("").alias("label"), F.array(F.lit("x [y]"), F.lit("z")).alias("endings"))
    return recipes.hellaswag(src, "train").select(F.col("extra_info.index").alias("index"), F.col("prompt")[0]["content"].alias("content"), F.col("reward_model.ground_truth").alias("truth"), F.trim(F.col("reward_model.choices")[0]).alias("choice"))


CORE.query("recipe_preference_sft", f"SELECT 'p' || k AS prompt, 'c' || k AS response FROM ({_OK}) UNION ALL SELECT 'p' || k, 'r' || k FROM ({_OK})")(lambda s, d: recipes.helpful_sft(_pairs(s, d)))


def _pairs(s, d):
    k = F.col("o_orderkey").cast("string")
    return table(s, d, "orders", F.concat(F.lit("p"), k).alias("prompt"), F.concat(F.lit("c"), k).alias("chosen"), F.concat(F.lit("r"), k).alias("rejected"))


CORE.query("recipe_search_qa", f"SELECT 'searchR1_nq' AS data_source, k AS index, 'Q: who ' || k || '?' AS content, 'a' || k AS target FROM ({_OK})")(
    lambda s, d: recipes.search_qa(table(s, d, "orders", F.col("o_orderkey").alias("index")).withColumns({"question": F.concat(F.lit("who "), F.col("index").cast("string"), F.lit("?")), "golden_answers": F.array(F.concat(F.lit("a"), F.col("index").cast("string"))), "data_source": F.lit("nq")}), "test", "sys", "Q: ").select(
        "data_source", F.col("extra_info.index").alias("index"), F.col("prompt")[1]["content"].alias("content"), F.col("reward_model.ground_truth.target")[0].alias("target")
    )
)
CORE.query("recipe_multiturn", "SELECT user_id, count(*) AS n, md5(string_agg(event_type || ':' || CAST(value AS VARCHAR), '|' ORDER BY event_id)) AS digest FROM events GROUP BY user_id")(
    lambda s, d: (
        lambda m: m.select("user_id", F.size("messages").cast("long").alias("n"), F.md5(F.array_join(F.transform("messages", lambda x: F.concat_ws(":", x["role"], x["content"])), "|")).alias("digest"))
    )(recipes.multiturn(table(s, d, "events", "user_id", "event_id", F.col("event_type").alias("role"), F.col("value").cast("string").alias("text")), "user_id", "event_id"))
)
CORE.query("recipe_char_count", f"SELECT k, CAST(length(CAST(k AS VARCHAR)) - length(replace(CAST(k AS VARCHAR), '1', '')) AS INTEGER) AS n FROM ({_OK})")(lambda s, d: (lambda o: recipes.char_count(o, F.col("w"), F.lit("1")).select(F.regexp_extract("prompt", r"word (\d+)\?", 1).cast("long").alias("k"), "n"))(table(s, d, "orders", F.col("o_orderkey").cast("string").alias("w"))))
CORE.query(
    "recipe_choices_prompt",
    f"""WITH a AS (SELECT k, i, ['right', 'no', 'nope'][i + 1] AS a, row_number() OVER (PARTITION BY k ORDER BY md5('3|' || k || '|' || i)) - 1 AS pl FROM ({_OK}), (VALUES (0), (1), (2)) t(i))
SELECT k, 'q' || k || '?' || chr(10) || chr(10) || string_agg(chr(CAST(65 + pl AS INTEGER)) || ') ' || a, chr(10) ORDER BY pl) AS text, max(CASE WHEN i = 0 THEN chr(CAST(65 + pl AS INTEGER)) END) AS gold FROM a GROUP BY k""",
)(
    lambda s, d: table(s, d, "orders", F.col("o_orderkey").alias("k"))
    .withColumn("c", recipes.choices_prompt(F.concat(F.lit("q"), F.col("k"), F.lit("?")), F.array(F.lit("right"), F.lit("no"), F.lit("nope")), 3, F.col("k")))
    .select("k", "c.text", "c.gold")
)
CORE.query("date_range_as_text", "SELECT o_orderkey FROM orders WHERE strftime(o_orderdate, '%Y-%m') || '-00' >= '1996-02' AND strftime(o_orderdate, '%Y-%m') || '-00' < '1996-09'")(lambda s, d: recipes.since(table(s, d, "orders", "o_orderkey", "o_orderdate").withColumn("t", F.concat(F.date_format("o_orderdate", "yyyy-MM"), F.lit("-00"))), "t", "1996-02", "1996-09").select("o_orderkey"))
CORE.query("ratio_split_by_hash", "SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY md5('42|' || o_orderkey), o_orderkey) <= floor(count(*) OVER () * 0.9) THEN 'train' ELSE 'test' END AS part FROM orders")(
    lambda s, d: batch.split_by_share(table(s, d, "orders", "o_orderkey"), 0.9, 42, "o_orderkey")
)
CORE.query("overlong_prompts_left_out", "SELECT l_orderkey, CAST(count(*) AS INTEGER) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) <= 4")(lambda s, d: readers.overlong(table(s, d, "lineitem", "l_orderkey", "l_linenumber").groupBy("l_orderkey").agg(F.collect_list("l_linenumber").alias("t")), "t", 4).select("l_orderkey", F.size("t").alias("n")))

# sinks and sources, round trips --------------------------------------------------------------------


def _folder(s, name):
    import uuid

    return f"{shared_dir(s)}/{name}-{uuid.uuid4().hex}"


@CORE.query("parquet_round_trip", "SELECT o_orderkey, o_orderstatus FROM orders")
def parquet_round_trip(s, d):
    path = writers.dataset(table(s, d, "orders", "o_orderkey", "o_orderstatus"), _folder(s, "ds"), "train")
    return readers.prompts(s, path, "o_orderkey", "o_orderstatus")


@CORE.query("generations_round_trip", "SELECT o_orderkey, o_orderstatus AS output, 7 AS step FROM orders")
def generations_round_trip(s, d):
    folder = _folder(s, "gen")
    writers.generations(table(s, d, "orders", "o_orderkey", F.col("o_orderstatus").alias("output")), folder, 7)
    return s.read.schema("o_orderkey bigint, output string, step int").json(folder)


@CORE.query("responses_collected", "SELECT o_custkey, string_agg(o_orderstatus, ',' ORDER BY o_orderkey) AS responses FROM orders GROUP BY o_custkey")
def responses_collected(s, d):
    o = table(s, d, "orders", "o_custkey", "o_orderkey", "o_orderstatus")
    return writers.with_responses(o.select("o_custkey").distinct(), o, "o_custkey", "o_orderkey", "o_orderstatus").select("o_custkey", F.array_join("responses", ",").alias("responses"))


@CORE.query("csv_report", "SELECT 'detail' AS row_kind, CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, NULL AS n FROM orders UNION ALL SELECT 'summary', NULL, o_orderstatus, CAST(count(*) AS VARCHAR) FROM orders GROUP BY o_orderstatus")
def csv_report(s, d):
    path, o = _folder(s, "csv"), table(s, d, "orders", "o_orderkey", "o_orderstatus")
    writers.report(o, o.groupBy("o_orderstatus").agg(F.count("*").alias("n")), path)
    return s.read.option("header", "true").csv(path).select("row_kind", "o_orderkey", "o_orderstatus", "n")


@CORE.query("jsonl_tolerant_read", "SELECT event_id, value FROM events")
def jsonl_tolerant_read(s, d):
    path = _folder(s, "jsonl")
    e = table(s, d, "events", "event_id", "value")
    e.select(F.to_json(F.struct("event_id", "value")).alias("value")).unionByName(s.createDataFrame([("{broken",), ("",)], "value string")).write.text(path)
    return readers.json_lines(s, path, "event_id bigint, value double")


@CORE.query("batch_saved_and_loaded", "SELECT o_orderkey, 42 AS seed FROM orders")
def batch_saved_and_loaded(s, d):
    path = _folder(s, "saved")
    writers.save_batch(table(s, d, "orders", "o_orderkey"), {"seed": 42}, path)
    rows, meta = readers.load_batch(s, path)
    return rows.withColumn("seed", F.lit(meta["seed"]))


CORE.query("metrics_tracked", "SELECT 3 AS step, unnest(['loss/pg', 'loss/vf', 'acc']) AS key, unnest([0.5, 0.25, 1.0])::DOUBLE AS value FROM region WHERE r_regionkey = 0")(lambda s, d: writers.metrics_long({"loss": {"pg": 0.5, "vf": 0.25}, "acc": 1}, 3, s).join(F.broadcast(table(s, d, "region", "r_regionkey").filter("r_regionkey = 0")), F.lit(True)).drop("r_regionkey"))
CORE.query("content_hash", "SELECT o_orderkey, sha1(o_orderpriority) AS sha1 FROM orders")(lambda s, d: table(s, d, "orders", "o_orderkey", "o_orderpriority").select("o_orderkey", F.sha1("o_orderpriority").alias("sha1")))

# streams ----------------------------------------------------------------------------------------------

CORE.query("windowed_completions", "SELECT time_bucket(INTERVAL '10 minutes', ts) AS window_start, event_type, count(*) AS n, round(avg(value), 6) AS mean_value FROM events GROUP BY 1, 2")(
    lambda s, d: monitor.windowed_completions(table(s, d, "events", "ts", "event_type", "value")).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("mean_value", 6).alias("mean_value"))
)
CORE.query(
    "sliding_completions",
    "WITH e AS (SELECT event_type, value, time_bucket(INTERVAL '5 minutes', ts) AS b FROM events) SELECT b - i.o AS window_start, event_type, count(*) AS n FROM e, (VALUES (INTERVAL '0 minutes'), (INTERVAL '5 minutes')) i(o) GROUP BY 1, 2",
)(lambda s, d: monitor.windowed_completions(table(s, d, "events", "ts", "event_type", "value"), slide="5 minutes").select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n"))
CORE.query(
    "user_sessions",
    "WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL '5 minutes' THEN 0 ELSE 1 END AS fresh FROM events), s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS no FROM g) SELECT user_id, min(ts) AS session_start, count(*) AS n FROM s GROUP BY user_id, no",
)(lambda s, d: monitor.sessions(table(s, d, "events", "ts", "user_id")).select("user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"), "n"))
CORE.query(
    "monitor_tick",
    f"""WITH {CATALOG}, n AS (SELECT id, coalesce(reward = 1, false) AS p FROM cat), s AS (SELECT id, CASE WHEN id % 4 = 0 THEN NOT p ELSE p END AS p, id % 4 = 0 AS c FROM n WHERE id % 3 > 0)
SELECT count(*) AS total_rows, count(*) FILTER (n.p) AS current_trainable, count(*) FILTER (s.id IS NULL) AS new_rollouts, count(*) FILTER (s.c) AS changed_rollouts, count(*) FILTER (s.id IS NULL AND n.p) AS new_trainables, count(*) FILTER (n.p AND NOT s.p) AS newly_passing FROM n LEFT JOIN s ON n.id = s.id""",
)(lambda s, d: _tick(catalog(s, d)))


def _tick(c):
    passes = F.col("reward") == 1
    now = monitor.tick(c, None, passes)[1]
    other = (F.col("id") % 4) == 0
    seen = now.filter("id % 3 > 0").select("id", F.when(other, "other").otherwise(F.col("row_hash")).alias("row_hash"), F.when(other, ~F.col("passes")).otherwise(F.col("passes")).alias("passes"))
    return monitor.tick(c, seen, passes)[0]


@CORE.query("streamed_completions", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def streamed_completions(s, d):
    """The events as a file stream through a windowed aggregation, to its end, then summed up."""
    import uuid

    name, path = f"completions_{uuid.uuid4().hex}", f"{d}/events.parquet"
    schema = s.read.parquet(path).schema
    folder = path.rpartition("/")[0]
    stream = s.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder) if _is_file(s, path) else s.readStream.schema(schema).parquet(path)
    counts = monitor.windowed_completions(stream.select("ts", "event_type", "value"))
    q = counts.writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination()
    return s.table(name).groupBy("event_type").agg(F.sum("n").alias("n"))


def _is_file(s, path):
    p = s.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(s.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isFile()


CORE.query("validation_metrics")(lambda s, d: _validation(s, d))
CORE.query(
    "validation_means",
    f"""WITH {CATALOG}, p AS (SELECT run_id, task_id, count(*) AS n, avg(reward) AS m, stddev_pop(reward) AS sd FROM cat WHERE reward IS NOT NULL GROUP BY ALL)
SELECT 'mean@' || n AS metric, round(avg(m), 9) + 0.0 AS value FROM p GROUP BY n UNION ALL SELECT 'std@' || n, round(avg(sd), 9) + 0.0 FROM p WHERE n > 1 GROUP BY n""",
)(lambda s, d: _validation(s, d).filter("metric like 'mean@%' or metric like 'std@%'").select("metric", (F.round("value", 9) + 0.0).alias("value")))


def _validation(s, d):
    """The rollouts of a task in a run are the samples of one prompt."""
    rows = catalog(s, d).filter("reward is not null")
    prompt = F.to_json(F.struct("run_id", "task_id"))
    return metrics.validation(rows.select(F.lit("catalog").alias("source"), prompt.alias("prompt"), F.lit("acc").alias("var"), F.col("reward").alias("value"), F.col("reward").cast("string").alias("vote"), F.col("id").alias("order")))


@CORE.query("supervised_nested_read", "SELECT 'p' || o_orderkey AS prompt, 'c' || o_orderkey AS response FROM orders")
def supervised_nested_read(s, d):
    path = _folder(s, "sft")
    _pairs(s, d).select(F.struct(F.col("prompt").alias("text")).alias("question"), F.struct(F.struct(F.col("chosen").alias("text")).alias("best")).alias("answers")).write.parquet(path)
    return readers.supervised(s, path, "question", "answers", ["text"], ["best", "text"])


@CORE.query("preference_read", "SELECT 'p' || o_orderkey AS prompt, 'c' || o_orderkey AS chosen, 'r' || o_orderkey AS rejected FROM orders")
def preference_read(s, d):
    path = _folder(s, "rm")
    _pairs(s, d).withColumn("unused", F.lit(1)).write.parquet(path)
    return readers.preferences(s, path)


@CORE.query("conversation_read_optional_columns", "SELECT user_id, 'x' AS tools, CAST(NULL AS VARCHAR) AS enable_thinking FROM events WHERE user_id % 2 = 0 UNION ALL SELECT user_id, NULL, NULL FROM events WHERE user_id % 2 = 1")
def conversation_read_optional_columns(s, d):
    """Two files, only one of which has a tools column, and none has enable_thinking."""
    path, e = _folder(s, "mt"), table(s, d, "events", F.col("user_id").alias("messages"))
    e.filter("messages % 2 = 0").withColumn("tools", F.lit("x")).write.parquet(f"{path}/a")
    e.filter("messages % 2 = 1").write.parquet(f"{path}/b")
    return readers.conversations(s, [f"{path}/a", f"{path}/b"]).withColumnRenamed("messages", "user_id")


@CORE.query("json_array_read", "SELECT r_regionkey, r_name FROM region")
def json_array_read(s, d):
    """The regions as one JSON array in one file."""
    path, r = _folder(s, "arr"), table(s, d, "region", "r_regionkey", "r_name")
    r.agg(F.to_json(F.collect_list(F.struct("r_regionkey", "r_name"))).alias("value")).coalesce(1).write.text(path)
    return readers.json_array(s, path, "r_regionkey int, r_name string")


@CORE.query("generations_evaluated", "WITH g AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 1.0 ELSE 0.0 END AS s FROM orders), p AS (SELECT o_custkey, avg(s) AS s FROM g GROUP BY 1) SELECT o_custkey % 5 AS data_source, round(avg(s), 6) AS score FROM p GROUP BY 1")
def generations_evaluated(s, d):
    """Offline evaluation: every response scored by rule, averaged per prompt, then per data source."""
    from tracemill.functions import scoring

    o = table(s, d, "orders", "o_custkey", F.concat(F.lit("so #### "), F.col("o_orderkey").cast("string")).alias("text"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderkey")).otherwise(-1).cast("string").alias("truth"), "o_orderkey")
    prompts = writers.with_responses(o.select("o_custkey").distinct(), o.withColumn("pair", F.struct("text", "truth")), "o_custkey", "o_orderkey", "pair")
    each = prompts.select("o_custkey", F.explode("responses").alias("r"))
    scored = each.select("o_custkey", (F.col("o_custkey") % 5).alias("data_source"), scoring.gsm8k_score(F.col("r.text"), F.col("r.truth")).alias("score"))
    return metrics.mean_of_means(scored, "data_source", "o_custkey", "score").select("data_source", F.round("score", 6).alias("score"))
