"""Queries on scores and text functions; the texts are made from keys of ``orders`` in both engines."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracemill.functions import actions, mathscore, scoring, text
from tracemill.plans.registry import CORE
from tracemill.session import table



def _orders(s, d):
    return table(s, d, "orders", F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("st"), F.col("o_orderpriority").alias("pr"))


_O = "WITH o AS (SELECT o_orderkey AS k, o_orderstatus AS st, o_orderpriority AS pr FROM orders) "
cat = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _q(name: str, sql: str, cols):
    """A query of (k, *cols()) over the keys; columns are made when it runs, as they need a session."""
    CORE.query(name, _O + sql)(lambda s, d: _orders(s, d).select("k", *cols()))


# GSM8K-style answers
_g = lambda: F.when(F.col("k") % 5 == 0, cat("no number here, ", F.col("k"))).when(F.col("k") % 5 == 1, cat("first #### 7 then #### $", F.col("k"), ",000")).when(F.col("k") % 5 == 2, cat("so it is ", F.col("k"), " . done")).otherwise(cat("it is #### ", F.col("k")))
_gs = "CASE WHEN k % 5 = 1 THEN k || '000' WHEN k % 5 IN (0, 2) THEN NULL ELSE CAST(k AS VARCHAR) END"
_q("gsm8k_strict", f"SELECT k, {_gs} AS answer FROM o", lambda: [scoring.gsm8k_strict(F.when(F.col("k") % 5 == 1, cat("first #### 7 then #### ", F.col("k"), ",000")).otherwise(_g())).alias("answer")])
_gf = "CASE WHEN k % 5 = 1 THEN k || ',000' ELSE CAST(k AS VARCHAR) END"
_q("gsm8k_flexible", f"SELECT k, {_gf} AS answer FROM o", lambda: [scoring.gsm8k_flexible(_g()).alias("answer")])
_q("gsm8k_score", f"SELECT k, CAST(CASE WHEN {_gs} IS NULL THEN 0.0 WHEN {_gs} = CAST(k AS VARCHAR) AND k % 2 = 0 THEN 1.0 ELSE 0.1 END AS DOUBLE) AS score FROM o", lambda: [scoring.gsm8k_score(F.when(F.col("k") % 5 == 1, cat("first #### 7 then #### ", F.col("k"), ",000")).otherwise(_g()), F.when(F.col("k") % 2 == 0, F.col("k").cast("string")).otherwise("x"), format_score=0.1).alias("score")])
_q("preprocess_answer", "SELECT k, k || '00' AS answer FROM o", lambda: [scoring.first_answer(cat("a #### ", F.col("k"), ",00 and #### 1")).alias("answer")])

# question answering
_q("qa_normalize", "SELECT k, 'cat ' || k || ' theory said' AS norm FROM o", lambda: [scoring.normalize_answer(cat("The Cat!!   ", F.col("k"), "\n an 'theory', said.")).alias("norm")])
_ans = lambda: F.when(F.col("k") % 4 == 0, cat("hm <answer> The ", F.col("k"), " </answer> x <answer>the  ", F.col("k"), "!</answer>")).when(F.col("k") % 4 == 1, cat("<answer>", F.col("k"), "</answer>", F.repeat(F.lit("<answer>z</answer>"), 11), "<answer>a ", F.col("k"), "</answer>")).when(F.col("k") % 4 == 2, cat("<answer>\nwrong\n</answer>")).otherwise(cat("none ", F.col("k")))
_q("qa_answer_tag", "SELECT k, CASE k % 4 WHEN 0 THEN 'the  ' || k || '!' WHEN 1 THEN 'a ' || k WHEN 2 THEN 'wrong' END AS answer FROM o", lambda: [F.regexp_replace(scoring.answer_tag(_ans()), r"^\s+|\s+$", "").alias("answer")])
_q("qa_exact_score", "SELECT k, CAST(CASE k % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 0.25 WHEN 2 THEN 0.1 ELSE 0.0 END AS DOUBLE) AS score FROM o", lambda: [scoring.qa_score(_ans(), F.array(F.lit("zzz"), F.col("k").cast("string")), format_score=0.1).alias("score")])
_q("qa_substring_score", "SELECT k, CAST(CASE k % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS score FROM o", lambda: [scoring.qa_score(_ans(), F.array(F.col("k").cast("string")), substring=True).alias("score")])
_q("qa_tag_counts", "SELECT k, CASE k % 4 WHEN 0 THEN 2 WHEN 1 THEN 13 WHEN 2 THEN 1 ELSE 0 END AS n FROM o", lambda: [scoring.count_of(_ans(), "</answer>").alias("n")])
_q("multiple_choice_score", "SELECT k, CAST(CASE WHEN k % 3 = 0 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS score FROM o", lambda: [scoring.choice_score(F.when(F.col("k") % 3 == 0, "so ANSWER: $B$ or Answer: C").when(F.col("k") % 3 == 1, "answer : b").otherwise("none"), F.lit("B")).alias("score")])
_q("judge_score_number", "SELECT k, CASE WHEN k % 3 = 0 THEN CAST(k AS DOUBLE) / 10 WHEN k % 3 = 1 THEN 0.5 END AS score FROM o", lambda: [scoring.score_number(F.when(F.col("k") % 3 == 0, cat("Score: ", (F.col("k") / 10))).when(F.col("k") % 3 == 1, "Score:.5 end").otherwise("none")).alias("score")])
_q(
    "score_dispatch",
    "SELECT k, CAST(CASE k % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 0.0 ELSE 0.25 END AS DOUBLE) AS score FROM o",
    lambda: [scoring.dispatch(F.when(F.col("k") % 3 == 0, "openai/gsm8k").when(F.col("k") % 3 == 1, "searchR1_nq").otherwise("lighteval/MATH"), {"openai/gsm8k": scoring.gsm8k_score(cat("#### ", F.col("k")), F.col("k").cast("string")), "searchR1_": scoring.qa_score(F.lit("x"), F.array(F.lit("x"))), "lighteval/MATH": F.lit(0.25)}).alias("score")],
)

# code and execution results
_q("extract_code", "SELECT k, CASE k % 3 WHEN 0 THEN E'\\nprint(' || k || E')\\n' WHEN 1 THEN 'x = ' || k || E'\\n' ELSE 'plain ' || k END AS code FROM o", lambda: [scoring.extract_code(F.when(F.col("k") % 3 == 0, cat("a ```python\nold\n``` b ```python\nprint(", F.col("k"), ")\n``` c")).when(F.col("k") % 3 == 1, cat("a ```sh\nx = ", F.col("k"), "\n``` c")).otherwise(cat("plain ", F.col("k")))).alias("code")])
_res = lambda: F.transform(F.sequence(F.lit(0), F.lit(11)), lambda i: ((F.col("k") + i) % 3 == 0).cast("int"))
_q("test_pass_rate", "SELECT k, len(list_filter(range(10), lambda i: (k + i) % 3 = 0)) / 10.0 AS rate FROM o", lambda: [scoring.pass_rate(_res()).alias("rate")])
_q("all_tests_passed", "SELECT k, CAST(CASE WHEN k % 2 = 0 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS score FROM o", lambda: [scoring.all_passed(F.when(F.col("k") % 2 == 0, F.array(F.lit(1), F.lit(1))).otherwise(F.array(F.lit(1), F.lit(0)))).alias("score")])
_q("compile_error_spread", "SELECT k, CASE WHEN k % 2 = 0 THEN '1,-4,-4,-4' ELSE '1,0,-2,1' END AS codes FROM o", lambda: [F.array_join(scoring.spread_compile_error(F.when(F.col("k") % 2 == 0, F.array(*[F.lit(x) for x in (1, -4, 1, 0)])).otherwise(F.array(*[F.lit(x) for x in (1, 0, -2, 1)]))), ",").alias("codes")])
_m = lambda *xs: F.get(F.array(*[F.lit(x) for x in xs]), (F.col("k") % len(xs)).cast("int"))
_q(
    "execution_codes",
    "SELECT k, CASE k % 6 WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN -1 WHEN 3 THEN -2 WHEN 4 THEN -3 ELSE -4 END AS code FROM o",
    lambda: [scoring.execution_code(_m("Success", "Success", "SandboxError", "Failed", "Failed", "Failed"), _m("Finished", "Finished", "Finished", "Finished", "Finished", "Error"), _m("Finished", "Finished", "Finished", "Finished", "TimeLimitExceeded", "Finished"), _m(0, 0, 0, 1, 0, 0), _m("5\n\n", "6", "5", "5", "5", "5"), F.lit("5\n")).alias("code")],
)
_q("output_comparison", "SELECT k, k % 3 <> 2 AS same FROM o", lambda: [scoring.same_output(_m(" 1\n2 \n", " 1 \n 2", "1 2"), F.lit("1\n2")).alias("same")])

# cleaning, formatting, parsing
_q("clean_activity_text", "SELECT k, 'go. now ' || k || ' and' AS t FROM o", lambda: [scoring.clean_activity(cat(" go [title]now [x]", F.col("k"), "  and ")).alias("t")])
_q("passage_lines", "SELECT k, 'Doc 1 (Title: a' || k || E') x\\nDoc 2 (Title: b) y\\n' AS t FROM o", lambda: [scoring.passage_lines(F.array(cat("a", F.col("k")), F.lit("b")), F.array(F.lit("x"), F.lit("y"))).alias("t")])
_sr = lambda: cat('{"query": "q', F.col("k"), '", "results": [{"title": "a"}, {"title": "b"}]}')
_q("search_result_fields", "SELECT k, 'q' || k AS query, 2 AS n_titles, '[{\"title\": \"a\"}, {\"title\": \"b\"}]' AS results FROM o", lambda: [scoring.search_results(_sr())["query"].alias("query"), scoring.search_results(_sr())["n_titles"].alias("n_titles"), scoring.search_results(_sr())["results"].alias("results")])
_q("media_segments", "SELECT k, 'a' || k || '|<image>|b|<video>|<image>' AS s FROM o", lambda: [F.array_join(text.segments(cat("a", F.col("k"), "<image>b<video><image>")), "|").alias("s")])
_q("md5_shard", "SELECT k, CAST(list_reduce(list_transform(range(1, 33), lambda i: strpos('0123456789abcdef', substring(md5(CAST(k AS VARCHAR)), CAST(i AS INTEGER), 1)) - 1), lambda a, x: (a * 16 + x) % 7) % 7 AS INTEGER) AS shard FROM o", lambda: [text.md5_shard(F.col("k").cast("string"), 7).alias("shard")])
_q("action_history", "SELECT k, 'Step 1: click ' || k || E'\\nStep 2: type' AS t FROM o", lambda: [text.history_text(F.array(cat("click ", F.col("k")), F.lit("type"))).alias("t")])
_q("merged_maps", "SELECT k, '1' AS a, CAST(k AS VARCHAR) AS b, 'z' AS c FROM o", lambda: [*[F.element_at(text.merge_maps(F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2")), F.create_map(F.lit("b"), F.col("k").cast("string"), F.lit("c"), F.lit("z"))), x).alias(x) for x in "abc"]])
_q("task_kinds", "SELECT k, CASE k % 3 WHEN 0 THEN 'os' WHEN 1 THEN 'web' ELSE 'general' END AS kind FROM o", lambda: [text.task_kind(_m("os_12", "openchrome9", "xyz"), {"chrome": "web"}, "general").alias("kind")])
_q("resized_smart", "SELECT k, CASE WHEN k % 2 = 0 THEN 1092 ELSE 84 END AS height, CASE WHEN k % 2 = 0 THEN 1932 ELSE 112 END AS width FROM o", lambda: [*[scoring.smart_size(F.when(F.col("k") % 2 == 0, 1080.0).otherwise(80.0), F.when(F.col("k") % 2 == 0, 1920.0).otherwise(100.0), 28, 8000, 3_000_000)[x].alias(x) for x in ("height", "width")]])
_q("resized_linear", "SELECT k, CAST(floor(1080 * sqrt(1000000.0 / (1080 * 1920))) AS INTEGER) AS height, CAST(floor(1920 * sqrt(1000000.0 / (1080 * 1920))) AS INTEGER) AS width FROM o", lambda: [*[scoring.linear_size(F.lit(1080.0), F.lit(1920.0), 1_000_000)[x].alias(x) for x in ("height", "width")]])
CORE.query("nested_columns_flattened", _O + "SELECT k, k + 1 AS \"a/b\", st AS \"a/c/d\" FROM o")(lambda s, d: text.flatten_columns(_orders(s, d).select("k", F.struct((F.col("k") + 1).alias("b"), F.struct(F.col("st").alias("d")).alias("c")).alias("a"))))
CORE.query("tool_attempt_reward", _O + "SELECT k, CAST(CASE WHEN (k % 3) / 2.0 > coalesce((lag(k % 3) OVER (PARTITION BY k % 100 ORDER BY k)) / 2.0, 0) THEN 0.0 ELSE -0.05 END AS DOUBLE) AS reward FROM o")(lambda s, d: _attempts(_orders(s, d)))


def _attempts(o):
    from pyspark.sql import Window as W

    s = (F.col("k") % 3) / 2
    return o.select("k", scoring.tool_reward(s, F.lag(s).over(W.partitionBy(F.col("k") % 100).orderBy("k"))).alias("reward"))


# answers that need the Arrow functions; the oracle knows them by construction
_box = lambda: F.when(F.col("k") % 4 == 0, cat("x \\boxed{1} so \\boxed{\\frac{", F.col("k"), "}{2}} y")).when(F.col("k") % 4 == 1, cat("thus \\boxed ", F.col("k"), "$ z")).when(F.col("k") % 4 == 2, cat("\\fbox{", F.col("k"), "}")).otherwise(cat("none ", F.col("k")))
_q("boxed_answers", "SELECT k, CASE k % 4 WHEN 0 THEN '\\frac{' || k || '}{2}' WHEN 3 THEN NULL ELSE CAST(k AS VARCHAR) END AS answer FROM o", lambda: [mathscore.boxed_answer_udf(_box()).alias("answer")])
_q("last_boxed", "SELECT k, CASE k % 4 WHEN 0 THEN '\\boxed{\\frac{' || k || '}{2}}' WHEN 1 THEN '\\boxed ' || k WHEN 2 THEN '\\fbox{' || k || '}' END AS boxed FROM o", lambda: [mathscore.last_boxed_udf(_box()).alias("boxed")])
_q("math_score", "SELECT k, CAST(CASE WHEN k % 4 = 0 OR k % 4 = 1 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS score FROM o", lambda: [mathscore.math_score_udf(_box(), F.when(F.col("k") % 4 == 0, cat("\\dfrac{", F.col("k"), "}{2}")).otherwise(F.when(F.col("k") % 4 == 2, F.lit("no")).otherwise(F.col("k").cast("string")))).alias("score")])
_q("latex_normalized", "SELECT k, CASE k % 3 WHEN 0 THEN '\\frac{1}{2}' WHEN 1 THEN '\\sqrt{3}' || k ELSE k || '.5' END AS t FROM o", lambda: [mathscore.normal_latex_udf(F.when(F.col("k") % 3 == 0, F.lit("x = \\tfrac12")).when(F.col("k") % 3 == 1, cat("\\sqrt3 ", F.col("k"))).otherwise(cat("\\left", F.col("k"), ".5\\%\\text{ cm}"))).alias("t")])
_q("final_answer_normalized", "SELECT k, k || '000' AS t FROM o", lambda: [mathscore.final_answer_udf(cat("x = $", F.col("k"), ",000$ dollars")).alias("t")])
_q("math_numeric_equal", "SELECT k, k % 4 <> 3 AS same FROM o", lambda: [mathscore.math_equal_udf(F.when(F.col("k") % 4 == 0, F.col("k").cast("string")).when(F.col("k") % 4 == 1, cat("$", F.col("k"))).when(F.col("k") % 4 == 2, cat("[", F.col("k"), ", 1.00001]")).otherwise(cat(F.col("k") + 1000000, "1")), F.when(F.col("k") % 4 == 2, cat("[", F.col("k"), ",1]")).otherwise(F.col("k").cast("string"))).alias("same")])
_q("geometry_score", "SELECT k, CAST(CASE k % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 0.9 ELSE 0.1 END AS DOUBLE) AS score FROM o", lambda: [F.round(mathscore.geo_score_udf(F.when(F.col("k") % 3 == 0, cat("<think>a\nb</think> \\boxed{", F.col("k"), "}")).when(F.col("k") % 3 == 1, cat("\\boxed{", F.col("k"), "}")).otherwise(cat("<think></think>\\boxed{no", F.col("k"), "}")), F.col("k").cast("string")), 6).alias("score")])
_dapo = lambda: mathscore.dapo_score_udf(F.when(F.col("k") % 2 == 0, cat("so Answer: $", F.col("k"), "$")).otherwise(cat("Answer: ", F.col("k"), "1")), F.col("k").cast("string"))
_q("dapo_score", "SELECT k, CAST(CASE WHEN k % 2 = 0 THEN 1.0 ELSE -1.0 END AS DOUBLE) AS score, k % 2 = 0 AS acc, CASE WHEN k % 2 = 0 THEN CAST(k AS VARCHAR) ELSE k || '1' END AS pred FROM o", lambda: [*[_dapo()[x].alias(x) for x in ("score", "acc", "pred")]])
_q("repetitive_text", "SELECT k, k % 2 = 0 AS rep FROM o", lambda: [mathscore.repetitive_udf(F.when(F.col("k") % 2 == 0, F.repeat(F.lit("ab"), 60)).otherwise(cat("the quick brown fox ", F.col("k")))).alias("rep")])
_q("custom_reward", "SELECT k, CAST(CASE WHEN k % 2 = 0 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS score FROM o", lambda: [mathscore.custom_score(lambda a, b: 1.0 / (int(a) % 2 == 0))(F.col("k").cast("string"), F.lit("")).alias("score")])
_act = lambda: cat("Thought: open it\nAction: click(start_box='(", F.col("k") % 1000, ",500)')")
_q("parsed_actions", "SELECT k, 'click' AS action_type, 'open it' AS thought FROM o", lambda: [F.get(actions.structured_udf(_act()), F.lit(0))["action_type"].alias("action_type"), F.get(actions.structured_udf(_act()), F.lit(0))["thought"].alias("thought")])
_call = lambda: actions.parse_call_udf(F.when(F.col("k") % 2 == 0, cat("scroll(direction='down', n=", F.col("k"), ")")).otherwise("not a call("))
_q("parsed_calls", "SELECT k, CASE WHEN k % 2 = 0 THEN 'scroll' END AS function, CASE WHEN k % 2 = 0 THEN '{\"direction\": \"down\", \"n\": ' || k || '}' END AS args FROM o", lambda: [_call()["function"].alias("function"), _call()["args"].alias("args")])
_q("action_code", "SELECT k, CASE WHEN k % 2 = 0 THEN 'pyautogui.press(''enter'')' ELSE 'DONE' END AS code FROM o", lambda: [actions.to_code_udf(F.when(F.col("k") % 2 == 0, "press").otherwise("finished"), F.lit('{"key": "enter"}')).alias("code")])
_q("quotes_escaped", "SELECT k, 'it\\''s ' || k AS t FROM o", lambda: [scoring.quote_escape(cat("it's ", F.col("k"))).alias("t")])
_q("accessibility_rows", "SELECT k, 2 AS n FROM o", lambda: [F.size(F.split(actions.accessibility_udf(cat("<d><b name='ok", F.col("k"), "' screencoord='(1, 2)' size='(3, 4)'/><c/></d>")), "\n")).alias("n")])
