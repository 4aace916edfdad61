"""Hashes, tokens, blocks and overlaps against brute force."""

import itertools
import json
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kaghamar.functions.codepoints import flatten
from kaghamar.llm import blocks, bpe, formatting, overlap


def frame(spark, texts, key="k", text="t"):
    """Rows with extra columns whose names operators use inside."""
    rows = [(i, t, "x", "y", 1, "z", 0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, f"{key} long, {text} string, id string, norm string, n int, salt string, first_id int")


def random_texts(n, seed, alphabet="abԱբև .,\n\t01ßéÉİ①ａ𝐀𠀀́​", most=30):
    r = random.Random(seed)
    return ["".join(r.choice(alphabet) for _ in range(r.randint(0, most))) for _ in range(n)]


def test_rolling_hashes_agree_with_canonical_strings():
    texts = random_texts(3000, 1, "aAbB ,.և") + ["ԵՎ", "եւ", "և", "Straße", "STRASSE", "x" * 200_000, ""]
    first, second, total = formatting.rolling_hashes(*flatten(pa.array(texts)))
    canonical = ["".join(formatting.folded(c) for c in t) for t in texts]
    by_hash, by_text = {}, {}
    for i, c in enumerate(canonical):
        by_hash.setdefault((first[i], second[i]), set()).add(i)
        by_text.setdefault(c, set()).add(i)
        assert total[i] == len(c)
    assert sorted(map(sorted, by_hash.values())) == sorted(map(sorted, by_text.values()))


def expected_copies(keys):
    first = {}
    out = set()
    for i, k in enumerate(keys):
        if k:
            if k in first:
                out.add((first[k], i))
            else:
                first[k] = i
    return out


@pytest.mark.parametrize("salt_rows", [50_000, 3])
def test_formatting_copies(spark, salt_rows):
    texts = [*random_texts(300, 2, "aAb .", 4), None, "", "  ", "...", "Same, text", "same text!", "SAME TEXT", "same text!", "long " * 20_000, "LONG" * 20_000]
    found = formatting.formatting_copies(frame(spark, texts), "k", "t", salt_rows=salt_rows).collect()
    canonical = ["".join(formatting.folded(c) for c in t) if t else "" for t in texts]
    assert len(found) == len(set(found)) and {tuple(r) for r in found} == expected_copies(canonical)
    records = {r["k"]: r["copies"] for r in formatting.collapse(frame(spark, texts), "k", "t").collect()}
    assert sum(records.values()) == len(texts)
    assert formatting.formatting_copies(frame(spark, texts).limit(0), "k", "t").count() == 0


def test_json_copies(spark):
    deep = {"a": ["X y", {"b": 1, "c": None}], "d": True}
    same = ['{"d": true, "a": ["x, Y", {"c": null, "b": 1.0}]}', json.dumps(deep), json.dumps(deep, indent=3)]
    other = ['{"d": 1, "a": ["x y", {"c": null, "b": 1}]}', '{"a": ["x y", {"b": "1", "c": null}], "d": true}', '{"a": [{"b": 1, "c": null}, "x y"], "d": true}', '{"a": ["x y", {"b": 1}], "d": true}']
    rest = ["{broken", '{"a": NaN}', None, "", "{}", "{}", "[" * 100_000]
    found = {tuple(r) for r in formatting.formatting_copies(frame(spark, same + other + rest), "k", "t", as_json=True).collect()}
    assert found == {(0, 1), (0, 2)}


@pytest.mark.parametrize("depth", [500, 3000, 200_000])
def test_deep_json_copies(spark, depth):
    deep = lambda leaf: '{"a": [' * depth + leaf + "]}" * depth
    texts = [deep('"Tun, 1"'), deep(' "tun 1" '), deep('"tun 2"'), deep('"tun 1"') + "]", deep("nope"), '{"a": [' * depth]
    assert [tuple(r) for r in formatting.formatting_copies(frame(spark, texts), "k", "t", as_json=True).collect()] == [(0, 1)]


def test_deep_parser_reads_as_json_does():
    for text in ['{"a": 1, "b": [true, null, "x\\u0531", {}], "a": [1.50, -2e3, []]}', " [ ] ", "3", '"x"', '{"a": {"b": {"c": ""}}}', "[1, [2, [3]], {}]"]:
        assert formatting.parse_deep(text) == formatting.parse(text)
    for text in ["", "[1,]", "[,1]", '{"a" 1}', '{"a": 1,}', "{a: 1}", "[1 2]", "[1]]", "[NaN]", "[1", '{"a": ', '["x]', "[01]", "nul"]:
        with pytest.raises(ValueError):
            formatting.parse_deep(text)


def test_byte_pairs_match_a_plain_encoder():
    tiktoken = pytest.importorskip("tiktoken")
    tool = bpe.PairIndexEncoder(bpe.default_vocabulary(), memory=200)
    plain = tiktoken.Encoding("plain", pat_str=bpe.PATTERN, mergeable_ranks=tool.rank, special_tokens={})
    texts = random_texts(400, 3, "abc  Աբգ՞։\n\t'sll01é👍🏽<|endoftext|>", 60) + [None, "", "aaaaaaaaaaaaaaaa", "<|endoftext|>", " " * 3000, "Ա" * 3000, "the " * 5000]
    for _ in range(2):  # again, with a memory that overflowed
        ids, counts = tool.encode(texts)
        ends = np.cumsum(counts)
        for text, a, b in zip(texts, ends - counts, ends):
            assert ids[a:b].tolist() == plain.encode_ordinary(text or "")


def test_document_ids(spark):
    texts = ["Hello", "", None, "Hello"]
    found = {r["k"]: r["ids"] for r in bpe.encode_documents(frame(spark, texts), "k", "t").collect()}
    assert found[1] == [] and found[2] is None and found[0] == found[3] and len(found) == 4
    counts = {r["k"]: r["n_tokens"] for r in bpe.token_counts(frame(spark, texts), "k", "t").collect()}
    assert counts == {0: len(found[0]), 1: 0, 2: None, 3: len(found[0])}
    assert bpe.encode_documents(frame(spark, texts).limit(0), "k", "t").count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_up_every_length(seed):
    r = np.random.default_rng(seed)
    lengths = r.integers(1, 65, 3000) if seed else np.full(1000, 40)
    counts = np.bincount(lengths, minlength=65)
    used, total = np.zeros(65, np.int64), 0
    for row, times in blocks.plan(counts, 64, slack=3, per_length=8):
        assert sum(row) <= 64 and times > 0
        total += times
        for v in row:
            used[v] += times
    assert (used == counts).all()
    assert not seed or lengths.sum() / (total * 64) > 0.97


def test_blocks_hold_every_token_once(spark):
    r = random.Random(5)
    sizes = [r.choice([0, None, 7, 7, 7, r.randint(1, 300), 64, 128]) for _ in range(900)]
    df = spark.createDataFrame([(i, n, "x", 1, 2, 3) for i, n in enumerate(sizes)], "doc_id int, n_tokens long, k string, n int, len int, bucket int")
    rows = blocks.fill_blocks(df, capacity=64, bucket_rows=20).collect()
    pieces, places = {}, {}
    for x in rows:
        pieces.setdefault(x["doc_id"], []).append((x["piece"], x["n_tokens"]))
        places.setdefault(x["block_id"], []).append((x["block_offset"], x["n_tokens"]))
    assert {k: sum(n for _, n in v) for k, v in pieces.items()} == {i: s for i, s in enumerate(sizes) if s}
    for doc, parts in pieces.items():
        parts.sort()
        assert [p for p, _ in parts] == list(range(len(parts))) and all(n == 64 for _, n in parts[:-1]) and (sizes[doc] > 64 or len(parts) == 1)
    for items in places.values():
        items.sort()
        assert sum(n for _, n in items) <= 64
        assert all(a + n == b for (a, n), (b, _) in itertools.pairwise(items)) and items[0][0] == 0
    assert sorted(places) == list(range(len(places)))
    assert blocks.fill_blocks(df.limit(0)).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_bound():
    r = random.Random(6)
    for _ in range(3000):
        a, b = ([r.randint(0, 3) for _ in range(r.randint(0, 9))] for _ in range(2))
        k = r.randint(0, 4)
        assert overlap.edits_within(a, b, k) == (distance(a, b) <= k)


@pytest.mark.parametrize("part_rows", [4000, 2])
def test_overlaps_match_brute_force(spark, part_rows):
    r = random.Random(7)
    words = "ա բ գ դ ե զ է ը թ ժ".split()
    base = [[r.choice(words) for _ in range(r.randint(1, 22) if i % 4 else r.randint(30, 70))] for i in range(40)]

    def near(x):
        x = list(x)
        for _ in range(r.randint(0, max(1, len(x) // 4))):
            at = r.randrange(len(x) + 1)
            x[at : at + r.randint(0, 1)] = [r.choice(words)] * r.randint(0, 1)
        return x

    texts = [[" ".join(near(r.choice(base))) for _ in range(n)] for n in (150, 60)]
    texts[0] += ["Ա, բ! գ դ ե", None, "", "…", "կոնկրետ նույնը այստեղ"]
    texts[1] += ["ա բ գ դ", None, "", "կոնկրետ նույնը այստեղ", "կոնկրետ նույնը այստեղ"]
    train = frame(spark, texts[0])
    evaluation = frame(spark, texts[1]).withColumn("k", F.col("k") + 1000)
    pairs = overlap.overlaps(train, evaluation, "k", "t", part_rows).persist()
    found = pairs.collect()
    expected = set()
    for i, a in enumerate(texts[0]):
        for j, b in enumerate(texts[1]):
            x, y = overlap.normalised(a).split(), overlap.normalised(b).split()
            if x and y and distance(x, y) <= max(len(x), len(y)) // 5:
                expected.add((i, 1000 + j))
    assert len(found) == len(set(found)) and {(r["train_id"], r["eval_id"]) for r in found} == expected
    assert all(0 < r["coverage"] <= 1 for r in found)
    report = overlap.overlap_report(pairs, train.withColumn("source", F.lit(None).cast("string")), evaluation.withColumn("source", F.lit("e")), "k").collect()
    assert {r["split"]: r["n_rows"] for r in report} == {"train": len(texts[0]), "eval": len(texts[1])}


def test_no_overlaps_of_empty_tables(spark):
    some = frame(spark, ["ա բ գ դ ե"])
    assert overlap.overlaps(some.limit(0), some, "k", "t").count() == 0


def test_rows_of_a_long_text_grow_with_its_words():
    r = random.Random(8)
    for n in (4, 5, 8, 11, 12, 19, 1000, 10_000):
        spans = overlap.Spans(pa.array([" ".join(r.choice("abcdefgh") + str(r.randint(0, 99)) for _ in range(n))]))
        at, length = spans.segments()
        assert len(at) == n // 4 + 1 and set(length.tolist()) <= {2, 3, 4}
        assert at[0] == 0 and (at[1:] == at[:-1] + length[:-1]).all() and at[-1] + length[-1] == n
        assert sum(len(x) for _, x in spans.suffixes()) <= 2 * n


def test_runs_of_the_suffix_array_end_with_the_common_prefix():
    r = random.Random(9)
    texts = [" ".join(r.choice("abc") for _ in range(r.randint(4, 30))) for _ in range(60)]
    spans = overlap.Spans(pa.array(texts))
    words = [t.split() for t in texts]
    for first in (2, 3):
        at = next(x for k, x in spans.suffixes() if k == first)
        left = spans.size[spans.row[at]] - spans.places()[at]
        rows = {"look": spans.look[first][at], "fourth": spans.fourth[at], "length": np.minimum(left, 4 if first == 3 else 2), "text_id": spans.row[at], "place": spans.places()[at], "size": spans.size[spans.row[at]], "mark0": at, "mark1": at}
        array = overlap.SuffixArray(rows)
        seg, length = spans.segments()
        mine = (length == 2) == (first == 2)
        seg, length = seg[mine], length[mine]
        low, high = array.runs(spans.look[first][seg], spans.fourth[seg], length)
        for s, n, a, b in zip(seg, length, low, high):
            row, place = spans.row[s], spans.places()[s]
            run = {(int(t), int(p)) for t, p in zip(array.rows["text_id"][a:b], array.rows["place"][a:b])}
            span = words[row][place : place + n]
            assert run == {(i, p) for i, w in enumerate(words) for p in range(len(w) - n + 1) if w[p : p + n] == span and (first == 3 or len(w) <= overlap.TWO_WORDS)}


def test_a_look_of_a_third_of_all_rows_is_split(spark):
    """Whatever share of the rows one look has, no part takes more than its bound of either side."""
    columns = "look long, fourth long, span long, length int, text_id long, place int, size int, mark0 long, mark1 long"
    rows = lambda n: [(0 if i % 3 == 0 else i, 0, 0, 3, i, 0, 9, 0, 0) for i in range(n)]
    segments, suffixes = spark.createDataFrame(rows(3000), columns), spark.createDataFrame(rows(900), columns)
    dealt = overlap._dealt(segments, suffixes, 100)
    counts = dealt.groupBy("look", "i", "j").agg(F.sum((~F.col("is_eval")).cast("int")).alias("a"), F.sum(F.col("is_eval").cast("int")).alias("b")).filter("look = 0").collect()
    assert len(counts) == 10 * 3 and max(r["a"] for r in counts) < 200 and max(r["b"] for r in counts) < 200
    # each segment meets each suffix of its look once
    assert sum(r["a"] * r["b"] for r in counts) == 1000 * 300


def test_a_record_of_a_third_of_all_rows_is_split(spark):
    texts = ["the same, text" if i % 3 == 0 else f"other {i}" for i in range(900)]
    found = {tuple(r) for r in formatting.formatting_copies(frame(spark, texts), "k", "t", salt_rows=40).collect()}
    assert found == {(0, i) for i in range(3, 900, 3)}
