"""Question-answer pairs out of loosely formatted model output, in tiers of tolerance.

Tier 1 takes JSON objects line by line and wins with three pairs or more; tier 2 takes the array
between the outermost brackets if it gives more pairs than tier 1; tier 3 sweeps for key-value
patterns in broken JSON if that gives more; tier 4 cuts the first balanced object out of each line
if nothing was found. Null and blank responses give no pairs.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kaghamar.functions.text import FENCE_CLOSE, FENCE_OPEN

QUESTION_KEYS, ANSWER_KEYS = ("question", "instruction"), ("answer", "output")
LEAST_LINES, LEAST_ANSWER = 3, 20
#: The shape of one pair in text that is no valid JSON.
SWEEP = re.compile(r'"(?:question|instruction)"\s*:\s*"(.+?)"\s*,\s*"(?:answer|output)"\s*:\s*"(.+?)"(?=\s*[},\n])', re.S)
DECODER = json.JSONDecoder()

Pair = tuple[str, str]


def tidy(question: object, answer: object) -> Pair | None:
    """The pair without outer quotes, if both are texts and the answer is long enough."""
    clean = lambda x: str(x or "").strip().strip('"').strip()
    q, a = clean(question), clean(answer)
    return (q, a) if q and len(a) > LEAST_ANSWER else None


def of_object(value: object) -> Pair | None:
    if not isinstance(value, dict):
        return None
    pick = lambda keys: next((value[k] for k in keys if value.get(k)), "")
    return tidy(pick(QUESTION_KEYS), pick(ANSWER_KEYS))


def loaded(text: str) -> object:
    try:
        return json.loads(text)
    except ValueError:
        return None


def object_lines(text: str) -> list[str]:
    lines = (line.strip().rstrip(",") for line in text.splitlines())
    return [line for line in lines if line.startswith("{")]


def leading_object(line: str) -> object:
    """The object that the line begins with, whatever follows it."""
    try:
        return DECODER.raw_decode(line)[0]
    except ValueError:
        return None


def found(values: Iterator[object]) -> list[Pair]:
    return [p for p in map(of_object, values) if p]


def parse_pairs(response: str | None) -> list[Pair]:
    text = (response or "").strip()
    if text.startswith("```"):
        text = re.sub(FENCE_CLOSE.replace(r"\z", r"\Z"), "", re.sub(FENCE_OPEN, "", text)).strip()
    pairs = found(map(loaded, object_lines(text)))
    if len(pairs) >= LEAST_LINES:
        return pairs
    first, last = text.find("["), text.rfind("]")
    if 0 <= first < last and isinstance(array := loaded(text[first : last + 1]), list):
        listed = found(iter(array))
        if len(listed) > len(pairs):
            return listed
    swept = [p for p in (tidy(q, a) for q, a in SWEEP.findall(text)) if p]
    pairs = max(pairs, swept, key=len)
    return pairs or found(map(leading_object, object_lines(text)))


def parse_array(response: str | None) -> list[Pair]:
    """The plain variant: the whole text, or what its fence holds, is one JSON array."""
    text = (response or "").strip()
    if "```" in text:
        text = text.split("```")[1].removeprefix("json")
    array = loaded(text.strip())
    return found(iter(array)) if isinstance(array, list) else []


def parsed_pairs(df: DataFrame, key: str, text: str, plain: bool = False) -> DataFrame:
    """(key, pos, instruction, input, output): the pairs of each response, in their order."""
    parse = parse_array if plain else parse_pairs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(k, i, q, "", a) for k, t in zip(batch.column("k").to_pylist(), batch.column("t").to_pylist()) for i, (q, a) in enumerate(parse(t))]
            columns = list(zip(*rows)) or [()] * 5
            types = [batch.schema.field("k").type, pa.int32(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["k", "pos", "instruction", "input", "output"])

    narrow = df.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    out = narrow.mapInArrow(run, f"k {narrow.schema['k'].dataType.simpleString()}, pos int, instruction string, input string, output string")
    return out.withColumnRenamed("k", key)
