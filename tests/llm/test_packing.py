import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_helpers import SF
from tokenizers import Tokenizer

from cartwheel.llm import packing


def check(got, rows):
    """Every piece is its document's, pieces tile the documents, places tile the sequences."""
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for i, text in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        n = len(ids)
        starts = [0, *range(n % 2048 or min(n, 2048), n, 2048)]
        want += [(i, k, s, e - s, zlib.crc32(ids[s:e].tobytes())) for k, (s, e) in enumerate(zip(starts, [*starts[1:], n], strict=True))]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == sorted(want, key=repr)
    assert all(p[3] == 2048 for p in want if p[1] > 0)
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for ps in places.values():
        at = 0
        for o, n in sorted(ps):
            assert o == at
            at += n
        assert at <= 2048
    return len(places), sum(p[3] for p in want)


def test_edge_cases(edge, rows):
    check(packing.pack(edge).collect(), rows)


def test_query(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    sequences, tokens = check(packing.pack(documents.repartition(6)).collect(), rows)
    assert sequences <= 1.05 * tokens / 2048 + 1
    assert len({r.sequence_id for r in packing.op6_packing(spark, SF).collect()}) <= 1.05 * tokens / 2048 + 1


@pytest.mark.parametrize("text", [
    "<|endoftext|> hi", "<|endoftext|>", "a<|endoftext|><|endoftext|>  b", "<|endoftext", "x <|ENDOFTEXT|> y", "",
    " " * 2_000_000, "\n" * 2_000_000, "a" + " \t\n\u00a0" * 300_000 + "b<|endoftext|>" + " " * 20_000 + "c",
    "ab " * 5000 + " " * 10_001 + "c", "a" * 300_000, "1" * 300_000, "é!" * 100_000])
def test_ids_are_those_of_the_tokenizer_file(text):
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert packing.Encoder("byte_bpe_50k").ids(text) == whole.encode(text, add_special_tokens=False).ids


def test_long_blanks_and_marks_are_packed(spark):
    rows = [(1, " " * 1_200_000), (2, "<|endoftext|> hi"), (3, "\n" * 1_200_000 + "x"), (None, "same"), (None, "same")]
    check(packing.pack(spark.createDataFrame(rows, "doc_id bigint, text string")).collect(), rows)


def test_empty_table(empty):
    assert packing.pack(empty).count() == 0


@pytest.mark.parametrize("limit", [1, 3, 1000])
def test_best_fit_with_bounded_bins(limit):
    rng = random.Random(limit)
    bins, open_, closed = packing.OpenBins(100, limit), [], []
    for k in range(2000):
        n = rng.randint(1, 100)
        done = bins.place((k, n), n)
        # the same by looking at every open sequence
        fits = [b for b in open_ if 100 - sum(x for _, x in b) >= n]
        expected = []
        if fits:
            b = max(fits, key=lambda b: sum(x for _, x in b))
        else:
            if len(open_) == limit and n < 100:
                fullest = max(open_, key=lambda b: sum(x for _, x in b))
                open_.remove(fullest)
                expected.append(sum(x for _, x in fullest))
            open_.append(b := [])
        b.append((k, n))
        if sum(x for _, x in b) == 100:
            open_.remove(b)
            expected.append(100)
        assert [sum(x for _, x in d) for d in done] == expected
        assert bins.count == len(open_) <= limit
        closed += done
    assert sum(map(len, closed)) + sum(map(len, bins.rest())) == 2000
