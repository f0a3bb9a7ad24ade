"""Preparation recipes: raw question sets as prompt, supervised and preference rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.functions import scoring

REASON = "Let's think step by step and output the final answer after \"####\"."


def _message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def prompt_row(df: DataFrame, source: str, ability: str, text: Column, truth: Column, split: str, index: Column, **extra: Column) -> DataFrame:
    """data_source, prompt, ability, reward_model and extra_info."""
    info = [F.lit(split).alias("split"), index.cast("long").alias("index"), *[c.alias(k) for k, c in extra.items()]]
    return df.select(
        F.lit(source).alias("data_source"), F.array(_message("user", text)).alias("prompt"), F.lit(ability).alias("ability"),
        F.struct(F.lit("rule").alias("style"), truth.alias("ground_truth")).alias("reward_model"), F.struct(*info).alias("extra_info"),
    )


def gsm8k(df: DataFrame, split: str, index: str = "index") -> DataFrame:
    q = F.concat(F.col("question"), F.lit(" " + REASON))
    return prompt_row(df, "openai/gsm8k", "math", q, scoring.first_answer(F.col("answer")), split, F.col(index), answer=F.col("answer"), question=F.col("question"))


def math(df: DataFrame, split: str, index: str = "index") -> DataFrame:
    from tracemill.functions.mathscore import boxed_answer_udf

    q = F.concat(F.col("problem"), F.lit(" Let's think step by step and output the final answer within \\boxed{}."))
    return prompt_row(df, "DigitalLearningGmbH/MATH-lighteval", "math", q, boxed_answer_udf("solution"), split, F.col(index))


def hellaswag(df: DataFrame, split: str, index: str = "index") -> DataFrame:
    """Context and cleaned endings; rows without a label go. The truth is the label's number."""
    ctx = scoring.clean_activity(F.concat(F.col("activity_label"), F.lit(": "), F.col("ctx_a"), F.lit(" "), F.initcap("ctx_b")))
    label = F.col("label").try_cast("int")
    truth = F.struct(F.lit("model").alias("style"), F.lit("multiple_choice").alias("eval"), label.alias("ground_truth"), F.transform("endings", scoring.clean_activity).alias("choices"))
    return df.filter(F.length("label") > 0).select(
        F.lit("Rowan/hellaswag").alias("data_source"), F.array(_message("user", ctx)).alias("prompt"), F.lit("nlp").alias("ability"), truth.alias("reward_model"),
        F.struct(F.lit(split).alias("split"), F.col(index).cast("long").alias("index")).alias("extra_info"),
    )


def helpful_sft(df: DataFrame) -> DataFrame:
    """Both answers of a preference pair as supervised rows."""
    return df.select("prompt", F.explode(F.array("chosen", "rejected")).alias("response"))


def helpful_pairs(df: DataFrame, train_share: float = 0.75) -> tuple[DataFrame, DataFrame]:
    """(train, test) pairs: the first share of rows by ``_row``, and the rest."""
    n = int(df.count() * train_share)
    return df.filter(F.col("_row") < n), df.filter(F.col("_row") >= n)


def helpful_rl(df: DataFrame, split: str) -> DataFrame:
    return df.select(
        F.lit("Dahoas/full-hh-rlhf").alias("data_source"), F.array(_message("user", F.col("prompt"))).alias("prompt"), F.lit("alignment").alias("ability"),
        F.struct(F.lit("model").alias("style"), F.col("response").alias("ground_truth")).alias("reward_model"), F.struct(F.lit(split).alias("split"), F.col("_row").cast("long").alias("index")).alias("extra_info"),
    )


def search_qa(df: DataFrame, split: str, system: str, instruction: str, index: str = "index") -> DataFrame:
    """Questions with the golden answers and the tool's creation arguments."""
    create = F.struct(F.col("golden_answers").alias("ground_truth"), F.col("question"), F.col("data_source"))
    return df.select(
        F.concat(F.lit("searchR1_"), "data_source").alias("data_source"),
        F.array(_message("system", F.lit(system)), _message("user", F.concat(F.lit(instruction), "question"))).alias("prompt"), F.lit("fact-reasoning").alias("ability"),
        F.struct(F.lit("rule").alias("style"), F.struct(F.col("golden_answers").alias("target")).alias("ground_truth")).alias("reward_model"),
        F.struct(F.lit(split).alias("split"), F.col(index).cast("long").alias("index"), F.lit(True).alias("need_tools_kwargs"), F.col("question"), F.struct(F.struct(create.alias("create_kwargs")).alias("search")).alias("tools_kwargs")).alias("extra_info"),
    )


def multiturn(df: DataFrame, conversation: str, position: str) -> DataFrame:
    """One row per conversation: messages in order."""
    m = F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), F.col("role"), F.col("text").alias("content"))))
    return df.groupBy(conversation).agg(F.transform(m, lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))


def choices_prompt(question: Column, answers: Column, seed: int, key: Column) -> Column:
    """Struct (text, gold): answers in a hash order, lettered A.. ; the first given answer is the right one."""
    order = F.array_sort(F.transform(answers, lambda a, i: F.struct(F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string"), i)).alias("h"), i.alias("i"), a.alias("a"))))
    letters = F.array(*[F.lit(x) for x in "ABCDEFGH"])
    lines = F.transform(order, lambda o, k: F.concat(F.get(letters, k), F.lit(") "), o["a"]))
    gold = F.get(letters, (F.array_position(F.transform(order, lambda o: o["i"]), F.lit(0)) - 1).cast("int"))
    return F.struct(F.concat(question, F.lit("\n\n"), F.array_join(lines, "\n")).alias("text"), gold.alias("gold"))


def char_count(df: DataFrame, word: Column, letter: Column) -> DataFrame:
    """Questions how often a letter occurs in a word, with the worked answer and the number."""
    n = F.length(word) - F.length(F.replace(word, letter))
    steps = F.transform(F.filter(F.split(word, ""), lambda x: x != ""), lambda c: F.concat(c, F.lit(" "), F.when(c == letter, "+1").otherwise("+0")))
    return df.select(
        F.concat(F.lit("How many "), letter, F.lit(" are there in word "), word, F.lit("?")).alias("prompt"),
        F.concat(F.array_join(steps, "\n"), F.lit("\nThus, there are \\boxed{"), n.cast("string"), F.lit("} "), letter, F.lit(" in "), word)
        .alias("response"), n.alias("n"),
    )


def since(df: DataFrame, date: str, first: str, last: str) -> DataFrame:
    """Rows whose ISO date text lies in [first, last), compared as text (months may have a day 00)."""
    return df.filter((F.col(date) >= first) & (F.col(date) < last))


def allow_listed(tasks: DataFrame, allowed: DataFrame, *on: str) -> DataFrame:
    return tasks.join(allowed.select(*on).distinct(), list(on), "left_semi")


DOMAIN_FIELDS = ("domain", "task_type", "category", "app")


def domain_of(config: Column) -> Column:
    """Domain of a task config in JSON: of the first of the four fields that is there, else of those in ``raw``, else ``unknown``."""

    def first(at: str) -> Column:
        keys = F.json_object_keys(F.get_json_object(config, at))
        found = F.lit(None).cast("string")
        for name in reversed(DOMAIN_FIELDS):
            found = F.when(F.array_contains(keys, name), F.get_json_object(config, f"{at}.{name}")).otherwise(found)
        return F.nullif(found, F.lit(""))

    return F.coalesce(first("$"), first("$.raw"), F.lit("unknown"))


def tasks_by_domain(df: DataFrame, config: str, reward: str) -> DataFrame:
    """``domain, task_id`` of the tasks with an id and a reward above 0, each once."""
    task = F.get_json_object(config, "$.id")
    return df.filter((F.col(reward) > 0) & (F.length(task) > 0)).select(domain_of(F.col(config)).alias("domain"), task.alias("task_id")).distinct()


def evaluation_set(df: DataFrame, source: str, question: Column, truth: Column, ability: str, style: str = "rule", index: str = "index", split: str = "test") -> DataFrame:
    """Rows of an evaluation benchmark in the prompt format, with the truth as text."""
    return prompt_row(df, source, ability, question, truth.cast("string"), split, F.col(index)).withColumn("reward_model", F.col("reward_model").withField("style", F.lit(style)))


def feasible(tasks: DataFrame, func: str = "func") -> DataFrame:
    return tasks.filter(F.coalesce(F.col(func), F.lit("")) != "infeasible")


def with_defaults(tasks: DataFrame, os: str = "ubuntu") -> DataFrame:
    """Adds ``task_id``, the config's id, and the operating system that runs use if none is named."""
    return tasks.withColumns({"task_id": F.col("id"), "os": F.lit(os)})


def missing_files(expected: DataFrame, present: DataFrame, on: str) -> DataFrame:
    return expected.join(present.select(on), on, "left_anti")


def unfinished(tasks: DataFrame, results: DataFrame) -> DataFrame:
    """Tasks without a result: no folder of the task's type whose name starts with the task id and that has a reward.

    This is an equi-join on the beginnings of folder names, of the lengths that task ids have.
    """
    lengths = tasks.agg(F.collect_set(F.length("task_id"))).scalar()  # few: ids are names of files
    cuts = F.filter("_lengths", lambda n: n <= F.length("folder"))
    done = results.filter("reward is not null and folder is not null").withColumn("_lengths", lengths)
    done = done.select("task_type", F.explode(F.transform(cuts, lambda n: F.substring("folder", F.lit(1), n))).alias("task_id")).distinct()
    return tasks.join(done, ["task_type", "task_id"], "left_anti")


def action_count(text: Column) -> Column:
    """Lines that follow the last ``Action:``."""
    return F.size(F.filter(F.split(F.trim(F.element_at(F.split(text, "Action:"), -1)), "\n"), lambda x: F.trim(x) != ""))
