import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from fixtures import AWKWARD, LONG, awkward, empty
from tiermill.llm.packing import best_fit, fillings, pack_documents, reduce_dominated, token_pieces, tokenizer_path
from tiermill.llm.tokens import WordIds


def test_word_ids_equal_the_tokenizer():
    ids, full = WordIds(tokenizer_path()), Tokenizer.from_file(tokenizer_path())
    assert ids.by_word
    rng = random.Random(5)
    texts = ["It's we'll I'M don't 'S x''ll ÀÉ×÷ ß ſ ﬁ İ e\u0301a b a<|endoftext|>b <| |> 12½ ²3 'sé ΣΑΣ 日本語\x85x \x1cy µª", "<|startoftext|>", "'", "", " "]
    texts += ["".join(rng.choice("aAéÉßñ'sSltTmdDreve 1\n.,!-<|>×\u0301 \u00a0") for _ in range(40)) for _ in range(500)]
    for t in texts:
        assert ids(t.encode()) == np.array(full.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes(), t


def brute(lengths, capacity):
    """Least number of sequences, by trying all."""
    best = [len(lengths)]

    def place(i, rooms):
        if len(rooms) >= best[0] and i < len(lengths):
            return
        if i == len(lengths):
            best[0] = min(best[0], len(rooms))
            return
        for k in range(len(rooms)):
            if rooms[k] >= lengths[i]:
                place(i + 1, rooms[:k] + [rooms[k] - lengths[i]] + rooms[k + 1:])
        place(i + 1, rooms + [capacity - lengths[i]])

    place(0, [])
    return best[0]


def test_reduction_keeps_an_optimum():
    rng = random.Random(2)
    for _ in range(150):
        lengths = sorted((rng.randint(1, 20) for _ in range(rng.randint(1, 7))), reverse=True)
        counts = np.bincount(lengths, minlength=21)
        fixed = reduce_dominated(counts, 20)
        left = [x for x in range(21) for _ in range(counts[x])]
        assert sum(n for _, n in fixed) + brute(left, 20) == brute(lengths, 20), lengths


def test_fillings_hold_every_piece_once():
    rng = np.random.default_rng(0)
    counts = np.bincount(rng.integers(1, 2049, 5000), minlength=2049)
    seen = np.zeros_like(counts)
    for filling, n in fillings(counts, 2048):
        assert sum(filling) <= 2048
        for x in filling:
            seen[x] += n
    assert (seen == counts).all()
    assert best_fit(np.bincount([3, 3, 3, 4], minlength=11), 10) == [([4, 3, 3], 1), ([3], 1)]


def test_pack_documents(spark):
    rows = pack_documents(awkward(spark), capacity=64).collect()
    full = Tokenizer.from_file(tokenizer_path())
    want = []
    for i, t in AWKWARD:
        ids = np.array([*full.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want += [(str(i), k, at, len(p), zlib.crc32(p.tobytes())) for k, at in enumerate(range(0, len(ids), 64)) for p in [ids[at:at + 64]]]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    by_seq = {}
    for r in rows:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by_seq.values():
        own.sort()
        assert own[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(own, own[1:])) and sum(x[1] for x in own) <= 64
    total = sum(r.length for r in rows)
    assert len(by_seq) <= 1.1 * total / 64 + 1


def test_pieces_with_ids(spark):
    rows = token_pieces(spark.createDataFrame([(1, LONG[:4000])], "doc_id long, text string"), with_ids=True).collect()
    assert all(zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32 for r in rows)


def test_empty(spark):
    assert pack_documents(empty(spark)).collect() == []
