import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from txrisk.llm import packing, token_output
from txrisk.llm.common import tokenizer_path
from txrisk.llm.tokens import RANKS, TOKENIZER, Encoder

from .conftest import plain_rows


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(tokenizer_path(TOKENIZER))
    return lambda text: t.encode(text, add_special_tokens=False).ids


ODD = ["", "a", " a", "a ", "a b ", "x\n", "\nx", "\n", " ", "a  b", "a \n b", "a\tb", "don't I'll 12 34", "\n a", "a\nb\nc", "x<|endoftext|>y z", "日本語 текст"]


@pytest.mark.parametrize("fast", [None, RANKS])
def test_encoder_equals_tokenizer(edge_docs, reference, fast):
    texts = ODD + [t for _, t in plain_rows(edge_docs)]
    enc = Encoder(tokenizer_path(TOKENIZER), fast and tokenizer_path(fast))
    for _ in range(2):
        for text, raw in zip(texts, enc.encode_all(texts)):
            assert np.frombuffer(raw, "<u4").tolist() == reference(text)


def check_pieces(rows, got, reference, sequence):
    want = defaultdict(list)
    for i, t in rows:
        ids = reference(t) + [1]
        for s in range(0, len(ids), 64):
            part = ids[s:s + 64]
            want[i, s].append((len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(ids)))
    have, rooms = defaultdict(list), defaultdict(list)
    for r in got:
        have[r["doc_id"], r["start"]].append((r["length"], r["ids_crc32"], r["doc_tokens"]))
        rooms[sequence(r)].append((r["offset"], r["length"]))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    for parts in rooms.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    return rooms


def test_packing_places_every_id_once(spark, edge_docs, reference):
    rooms = check_pieces(plain_rows(edge_docs), packing.pack_documents(edge_docs, 64).collect(), reference, lambda r: r["sequence_id"])
    assert sorted(rooms) == list(range(len(rooms)))
    assert packing.pack_documents(edge_docs.limit(0), 64).count() == 0


def test_matrices_round_trip(spark, edge_docs, reference):
    shards = token_output.packed_shards(edge_docs, 64, shard_ids=20_000).cache()
    check_pieces(plain_rows(edge_docs), token_output.segments(shards).collect(), reference, lambda r: (r["shard"], r["row"]))
    for row in shards.collect():
        ids, ends, positions = token_output.read_shard(row)
        assert ends[0] == 0 and ends[-1] == ids.size and (np.diff(ends) > 0).all()
        assert sorted(set(row["resets"]) - set(np.flatnonzero(positions.ravel() == 0).tolist())) == []
        for r, o, n in zip(row["rows"], row["offsets"], row["lengths"]):
            assert positions[r, o:o + n].tolist() == list(range(n))
    assert token_output.packed_shards(edge_docs.limit(0), 64).count() == 0


def test_shortest_pack_first_uses_every_piece():
    histogram = {1: 50, 3: 7, 10: 1000, 33: 12, 60: 5, 64: 3}
    slots = packing.shortest_pack_first(histogram, 64)
    count, filled = defaultdict(int), defaultdict(int)
    for length, rank, n, sequence, offset in sorted(slots, key=lambda s: s[4]):
        assert rank >= 0
        count[length] += n
        for k in range(sequence, sequence + n):
            assert filled[k] == offset
            filled[k] += length
    assert dict(count) == histogram and max(filled.values()) <= 64


def test_best_fit_takes_the_fullest_row_with_room():
    lengths = [60, 40, 33, 24, 20, 4, 4, 1]
    places, n = token_output.best_fit_decreasing(lengths, 64)
    room = [64] * n
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        row, offset = places[k]
        fits = [x for x in room if x >= lengths[k] and x < 64]
        assert offset == 64 - room[row] and (room[row] == min(fits) if fits else room[row] == 64)
        room[row] -= lengths[k]
