import public_tokenizers
from helpers_llm import documents, prose
from tokenizers import Tokenizer

from modspark.llm import token_counts as t

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_counts_are_those_of_the_library(spark):
    library = Tokenizer.from_file(PATH)
    odd = ["", None, " ", "\n\n", "a", " a  b ", "x\n y\n\nz", "don't we'll", "<|endoftext|> a<|endoftext|>  <|endof text|>", "a\u00a0b \u3000c",
           "日本語 テキスト", "tab\tand\r\nreturn", "a\0b \0 c", "9 99 999,9", "🙂 🙂🙂", "é" * 5000, "nospace" * 3000, " " * 9000 + "x",
           prose(1, 4000), prose(2, 3000).replace(" ", "\n"), "#" * 4000 + " end " + "<|endoftext|> " * 700]
    rows = [(i, x) for i, x in enumerate(odd)] + [(None, "no id"), (3, "again"), (3, "again")]
    want = sorted((str(i), len((x or "").encode()), len(library.encode(x or "", add_special_tokens=False).ids)) for i, x in rows)
    for chunk, overlap in ((32_768, 512), (500, 60)):
        got = t.token_counts(documents(spark, rows), PATH, chunk=chunk, overlap=overlap).collect()
        assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want
        assert all(r.over_limit == (r.n_tokens > 512) for r in got)


def test_empty_table(spark):
    assert t.token_counts(documents(spark, [(1, "a")]).limit(0), PATH).count() == 0
