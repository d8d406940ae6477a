import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from lakejobs.llm.packing import RANKS, TOKENIZER, pack, token_ids
from tokenizers import Tokenizer

ODD = [
    None, "", "a", " ", "\n\n  x \t\n", "<|endoftext|> in <|endoftext|>", "naïve café ÀÉ ß", "日本語 テキスト", "🙂 👩‍👩‍👧 ok", "​  x",
    "a" * 5000, "İı ǅ Ωμέγα привет", "don't we'll I'M", "1234567 ½ ²", "\x00\x07 \x7f", "é กำ", "x   y \r\n z",
]


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(public_tokenizers.path(TOKENIZER))


def ids_of(whole, text):
    return [*whole.encode(text or "", add_special_tokens=False).ids, 1]


def test_both_libraries_give_the_same_ids(whole, real_texts):
    texts = ODD + [text for _, text in real_texts]
    paths = public_tokenizers.path(TOKENIZER), public_tokenizers.path(RANKS)
    want = [ids_of(whole, x) for x in texts]
    assert [x.tolist() for x in token_ids(pa.array(texts), *paths)] == want
    assert [x.tolist() for x in token_ids(pa.array(texts[:40]), paths[0], None)] == want[:40]


@pytest.mark.parametrize("length", [2048, 7])
def test_round_trip(spark, documents, real_texts, whole, length):
    texts = [*enumerate(ODD), *((1000 + i, text) for i, text in real_texts)]
    texts = texts if length == 2048 else texts[:60]
    docs = documents(texts, extra=["run", "ids", "at"]).repartition(5)
    rows = pack(docs, length=length).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert len(r.ids) == 4 * r.length and zlib.crc32(bytes(r.ids)) == r.ids_crc32
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, text in texts:
        own = sorted(pieces[i], key=lambda r: r.start)
        ids = np.concatenate([np.frombuffer(bytes(r.ids), "<u4") for r in own]).tolist()
        assert ids == ids_of(whole, text)
        assert [r.start for r in own] == np.cumsum([0, *(r.length for r in own)])[:-1].tolist()
        assert {r.doc_tokens for r in own} == {len(ids)}
    assert sorted(sequences) == list(range(len(sequences)))
    for i, places in sequences.items():
        places.sort()
        assert [o for o, _ in places] == np.cumsum([0, *(n for _, n in places)])[:-1].tolist()
        assert sum(n for _, n in places) == length or i == len(sequences) - 1


def test_repeated_rows_and_empty_table(documents):
    rows = pack(documents([(1, "same text"), (1, "same text"), (None, "x")])).collect()
    assert sorted((r.doc_id or 0) for r in rows) == [0, 1, 1]
    assert pack(documents([])).collect() == []
