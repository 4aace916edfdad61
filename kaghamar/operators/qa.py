"""Question-answer operators: labels, multiple choice, benchmark builders, filters, chat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kaghamar.functions.text import ARTIFACTS, ASSISTANT, BLOCKLIST, END, USER, any_of, norm_key, script_ratio, strip, ws_clean
from kaghamar.operators.corpus import keep_first

#: Letters of answer choices, and the words of the context template.
LETTERS = ("Ա", "Բ", "Գ", "Դ", "Ե", "Զ", "Է", "Ը", "Թ", "Ժ")
CONTEXT, QUESTION = "Տեքստ:\n", "\n\nՀարց: "
OPEN_TASK, CHOICE_TASKS = 7, (1, 6)


def single_label(kind: Column, text: Column, number: Column, n: Column, strict: bool = False) -> Column:
    """The 0-based place of the right choice; null if there is none.

    Digit strings count from 1; letters from A, and may lie beyond the choices; integers count from 0
    if that is a place and from 1 if they equal n. With `strict`, integers count from 1 throughout.
    """
    digits = text.rlike("^[0-9]+$")
    place = text.try_cast("int") - 1 if hasattr(text, "try_cast") else text.cast("int") - 1
    from_digits = F.when((place >= 0) & (place < n), place)
    upper = F.upper(text)
    from_letter = F.when(upper.rlike("^[A-H]$"), F.ascii(upper) - 65)
    from_number = F.when((number >= 1) & (number <= n), number - 1) if strict else F.when((number >= 0) & (number < n), number).when(number == n, n - 1)
    return F.when(kind == "int", from_number).when(kind == "str", F.when(digits, from_digits).otherwise(from_letter)).cast("int")


def with_context(question: Column, context: Column) -> Column:
    has = F.coalesce(context, F.lit("")) != ""
    return F.when(has, F.concat(F.lit(CONTEXT), strip(context), F.lit(QUESTION), question)).otherwise(question)


def mcq(question: Column, choices: Column, place: Column, context: Column | None = None) -> tuple[Column, Column]:
    """(instruction, output); both null with over ten choices or a place beyond them."""
    letters = F.array(*[F.lit(x) for x in LETTERS])
    lines = F.array_join(F.transform(choices, lambda c, i: F.concat(F.get(letters, i), F.lit(") "), strip(c))), "\n")
    body = with_context(strip(question), context) if context is not None else strip(question)
    fine = (F.size(choices) <= len(LETTERS)) & (place >= 0) & (place < F.size(choices))
    instruction = F.when(fine, F.concat(body, F.lit("\n\n"), lines))
    output = F.when(fine, F.concat(F.get(letters, place), F.lit(") "), strip(F.get(choices, place))))
    return instruction, output


def _pairs(df: DataFrame, instruction: Column, output: Column, source: str) -> DataFrame:
    return df.select(instruction.alias("instruction"), F.lit("").alias("input"), output.alias("output"), F.lit(source).alias("source"))


def _text(name: str) -> Column:
    return strip(F.coalesce(F.col(name).cast("string"), F.lit("")))


def exam_pairs(df: DataFrame, config: str, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(pairs, skipped): exam rows (task_type, question, context, task, choices, label_kind, label_str, label_int).

    Task type 7 is open, its label the answer; 1 and 6 are multiple choice; others, and labels that
    name no choice, are counted by task type. Rows without a question or label are dropped uncounted.
    """
    question, task, context = _text("question"), _text("task"), _text("context")
    rows = df.filter((question != "") & F.col("label_kind").isNotNull())
    full = F.when(task != "", strip(F.concat(task, F.lit(" "), question))).otherwise(question)
    place = single_label(F.col("label_kind"), F.col("label_str"), F.col("label_int"), F.size("choices"), strict)
    instruction, output = mcq(full, F.col("choices"), place, context)
    choice = F.col("task_type").isin(*CHOICE_TASKS)
    answer = strip(F.coalesce(F.col("label_str"), F.col("label_int").cast("string"), F.lit("")))
    opened = rows.filter((F.col("task_type") == OPEN_TASK) & (answer != ""))
    listed = rows.filter(choice & (F.size("choices") > 0)).withColumn("i", instruction).withColumn("o", output)
    pairs = _pairs(opened, with_context(full, context), answer, f"armbench/{config}/open").unionByName(
        _pairs(listed.filter("i is not null and o is not null"), F.col("i"), F.col("o"), f"armbench/{config}/mcq")
    )
    other = rows.filter(~choice & (F.col("task_type") != OPEN_TASK) | F.col("task_type").isNull()).select("task_type")
    skipped = other.unionByName(listed.filter("i is null or o is null").select("task_type"))
    return pairs, skipped.groupBy("task_type").agg(F.count("*").alias("n_skipped"))


def four_choice_pairs(df: DataFrame, options: list[str], config: str, context: str | None = None, strict: bool = False) -> DataFrame:
    """Rows with a question and exactly four non-empty options; labels in (label_kind, label_str, label_int)."""
    choices = F.filter(F.array(*[F.coalesce(F.col(o).cast("string"), F.lit("")) for o in options]), lambda x: x != "")
    rows = df.withColumn("_choices", choices).filter((_text("question") != "") & (F.size("_choices") == 4))
    place = single_label(F.col("label_kind"), F.col("label_str"), F.col("label_int"), F.lit(4), strict)
    instruction, output = mcq(_text("question"), F.col("_choices"), place, _text(context) if context else None)
    return _pairs(rows, instruction, output, f"armbench/{config}").filter("instruction is not null and output is not null")


def shuffled(question: Column, choices: Column) -> Column:
    """The choices in the order of md5(question, place), the same in every run."""
    keyed = F.transform(choices, lambda c, i: F.struct(F.md5(F.concat(question, F.lit("|"), i.cast("string"))).alias("k"), c.alias("c")))
    return F.transform(F.array_sort(keyed), lambda x: x["c"])


def public_service_pairs(df: DataFrame, config: str = "public-services-mcqa") -> DataFrame:
    """An open pair for each row, and a shuffled multiple-choice pair for those with distractors."""
    question, answer = _text("question"), _text("answer")
    rows = df.filter((question != "") & (answer != ""))
    listed = rows.filter(F.size("distractors") > 0).withColumn("_all", F.concat(F.array(answer), F.col("distractors")))
    keys = F.transform(F.col("_all"), lambda c, i: F.md5(F.concat(question, F.lit("|"), i.cast("string"))))
    place = F.size(F.filter(keys, lambda k: k < F.get(keys, F.lit(0))))
    instruction, output = mcq(question, shuffled(question, F.col("_all")), place)
    pairs = _pairs(listed, instruction, output, f"armbench/{config}/mcq").filter("instruction is not null")
    return _pairs(rows, question, answer, f"armbench/{config}/open").unionByName(pairs)


def open_pairs(df: DataFrame, config: str, context: str | None = None, answer: str = "answer") -> DataFrame:
    """question and answer, the answer's first element if it is a list, under a context if there is one."""
    first = F.get(F.col(answer), 0) if df.schema[answer].dataType.typeName() == "array" else F.col(answer)
    text = strip(F.coalesce(first.cast("string"), F.lit("")))
    rows = df.filter((_text("question") != "") & (text != ""))
    question = with_context(_text("question"), _text(context)) if context else _text("question")
    return _pairs(rows, question, text, f"armbench/{config}")


def aya_reasons(question: Column, answer: Column, min_q: int = 10, max_q: int = 2000, min_a: int = 20, max_a: int = 2000, ratio: float = 0.75) -> list[tuple[str, Column]]:
    """(name, condition) of what drops a translated pair, in order; both texts already cleaned."""
    return [
        ("empty", (question == "") | (answer == "")),
        ("question_length", ~F.length(question).between(min_q, max_q)),
        ("answer_length", ~F.length(answer).between(min_a, max_a)),
        ("artifact", any_of(question, ARTIFACTS) | any_of(answer, ARTIFACTS)),
        ("script", (script_ratio(answer) < ratio) | (script_ratio(question) < ratio - 0.2)),
        ("same", norm_key(question) == norm_key(answer)),
        ("stub", (F.length(question) > 300) & (F.length(answer) < 15)),
    ]


def aya_pairs(df: DataFrame, question: str, answer: str, dataset: str, key: str, **bounds: float) -> DataFrame:
    """(key, instruction, input, output, source) of the pairs that pass, before deduplication."""
    one = F.struct(ws_clean(F.col(question)).alias("q"), ws_clean(F.col(answer)).alias("a"))

    def good(x: Column) -> Column:
        bad = F.lit(False)
        for _, condition in aya_reasons(x["q"], x["a"], **bounds):
            bad = bad | condition
        return ~bad

    # within the lambda both texts are cleaned once, whereas a filter over aliases would clean them in each condition
    rows = df.select(F.col(key), F.col(dataset).alias("source"), F.explode(F.filter(F.array(one), good)).alias("p"))
    return rows.select(key, F.col("p.q").alias("instruction"), F.lit("").alias("input"), F.col("p.a").alias("output"), "source")


def merge_pairs(pairs: DataFrame, rank: str, key: str) -> DataFrame:
    """Keep-first by the instruction's key in the order of (rank, key); rows with an empty key are dropped."""
    keyed = pairs.withColumn("norm", norm_key(F.col("instruction"))).filter("norm <> ''")
    return keep_first(keyed, F.col("norm"), [rank, key])


def appropriate(instruction: Column, input_: Column, output: Column) -> Column:
    """No blocked substring, and an output of ten characters or more, unstripped."""
    empty = lambda c: F.coalesce(c, F.lit(""))
    text = F.lower(F.concat_ws(" ", empty(instruction), empty(input_), empty(output)))
    return ~any_of(text, BLOCKLIST) & (F.length(empty(output)) >= 10)


def chat(instruction: Column, input_: Column, output: Column) -> Column:
    """One tagged line of a user and an assistant turn."""
    said = strip(F.coalesce(input_, F.lit("")))
    user = F.when(said != "", F.concat(strip(instruction), F.lit("\n"), said)).otherwise(strip(instruction))
    return F.concat(F.lit(USER), user, F.lit(END + ASSISTANT), strip(output), F.lit(END))


def response(text: Column) -> Column:
    """What follows the last assistant tag, without tags."""
    last = F.substring_index(text, ASSISTANT, -1)
    return strip(F.replace(F.replace(last, F.lit(END), F.lit("")), F.lit(USER), F.lit("")))
