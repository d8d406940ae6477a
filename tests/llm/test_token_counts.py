import public_tokenizers
import pytest
from lakejobs.llm.token_counts import Lengths, PreTokens, TokenCountParams, _OTHERS, _worker_cache, count_tokens, counter
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None,
    "",
    " ",
    "   \n\n\t x  ",
    "it's we'll THEY'RE 'sx ''s x's'",
    "a<|endoftext|>b <|endoftext|><|endoftext|> c<|endoftext",
    "naïve café — “quoted” … 123 456abc",
    "日本語の文章です。 한국어 문장",
    "՘֋ \U00010940 Ⱟ꟎ mixed",
    "x\u0085y\u001cz  　 w",
    "a" * 50_000,
    " " * 3_000 + "b",
    "word " * 40_000,
]


def expected(texts):
    coder = Tokenizer.from_file(PATH)
    return [len(coder.encode(x or "", add_special_tokens=False).ids) for x in texts]


def counted(df, params=None):
    rows = count_tokens(df, params=params).collect()
    return {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in rows}


def test_odd_texts_as_the_library_counts_them(documents):
    found = counted(documents(ODD, extra=("n_tokens", "n_bytes")))
    want = {i: (len((x or "").encode()), n, n > 1024) for i, (x, n) in enumerate(zip(ODD, expected(ODD), strict=True))}
    assert found == want


def test_documents_as_the_library_counts_them(spark, sf_dir, real_texts):
    found = counted(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    want = dict(zip([i for i, _ in real_texts], expected([x for _, x in real_texts]), strict=True))
    assert {i: x[1] for i, x in found.items()} == want


def test_table_and_pieces_only_change_the_speed(documents):
    texts = [x for x in ODD if x] + ["the cat sat on the mat " * 50]
    plain = counted(documents(texts))
    for params in (TokenCountParams(table_size=0), TokenCountParams(table_size=3, cache_size=2, piece_chars=7)):
        assert counted(documents(texts), params) == plain


def test_tiers():
    params = TokenCountParams(cache_size=3, cache_chars=8)
    _worker_cache(PATH).clear()
    lengths = Lengths({"frequent": 99}, PATH, params)
    assert lengths["frequent"] == 99, "the first tier is asked first"
    assert lengths["hello"] == expected(["hello"])[0] and "hello" not in lengths and lengths.cache == {"hello": lengths["hello"]}
    lengths["a very long one"], lengths["b"], lengths["c"], lengths["d"]
    assert set(lengths.cache) == {"d"}, "long ones are not kept, and a full cache starts anew"


def test_characters_of_which_both_expressions_think_alike():
    pre = PreTokens(PATH)
    for code in (x for x in range(0x10000) if not 0xD800 <= x < 0xE000 and not _OTHERS.match(chr(x))):
        text = f"a{chr(code)}1{chr(code)}!{chr(code)} {chr(code)}{chr(code)}b"
        assert [b - a for _, (a, b) in pre.coder.pre_tokenizer.pre_tokenize_str(text)] == list(map(len, pre.pattern.findall(text))), hex(code)


def test_rows_without_id_repeated_rows_and_no_rows(documents):
    rows = count_tokens(documents([(None, "a b"), (1, "c"), (1, "c")])).collect()
    assert sorted((r.doc_id is None, r.n_tokens) for r in rows) == [(False, 1), (False, 1), (True, 2)]
    assert count_tokens(documents([])).collect() == []


def test_limit_is_exclusive():
    count = counter({}, PATH, TokenCountParams())
    assert count(" a" * 1024) == 1024


def test_other_tokenizers_are_refused(documents):
    with pytest.raises(ValueError, match="byte-level"):
        count_tokens(documents(["x"]), public_tokenizers.path("word_bpe_49k.json"))
