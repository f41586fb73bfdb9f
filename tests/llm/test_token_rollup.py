from collections import Counter

import public_tokenizers
from helpers import WORD, awkward, rows
from tokenizers import Tokenizer

from cityviews.llm.token_rollup import Rollup, rollup_documents

PATH = public_tokenizers.path("word_bpe_49k.json")
CHANGES = "source string, lang string, version string, op string, old_tokens long, new_tokens long"


def test_signed_batches_count_once(spark, tmp_path):
    rollup = Rollup(spark, str(tmp_path / "r"))
    assert rollup.totals().count() == 0
    first = spark.createDataFrame(
        [("a", "en", "1", "insert", None, 5), ("a", "en", "1", "insert", None, 7), ("b", None, "1", "insert", None, None)],
        CHANGES)
    assert rollup.commit("one", first)
    assert not rollup.commit("one", first)
    assert not Rollup(spark, str(tmp_path / "r")).commit("one", first)
    second = spark.createDataFrame(
        [("a", "en", "1", "delete", 5, None), ("a", "en", "1", "revise", 7, 9), ("b", None, "1", "delete", None, None)],
        CHANGES)
    assert rollup.commit("two", second)
    assert rows(rollup.totals()) == [("a", "en", "1", 1, 9)]


def test_batches_without_a_commit_do_not_count(spark, tmp_path):
    rollup = Rollup(spark, str(tmp_path / "r"))
    spark.createDataFrame([("a", "en", "1", 1, 1)], "source string, lang string, version string, docs long, tokens long"
                          ).write.parquet(str(tmp_path / "r/batches/lost"))
    assert rollup.totals().count() == 0


def test_awkward_rows(spark, tmp_path):
    docs = awkward(spark)
    data = [(r.doc_id, r.text or "", r.source, r.lang) for r in docs.collect()]
    first = {}
    for i, text, *_ in data:
        if i is not None:
            first[text] = min(first.get(text, i), i)
    count, tokens = Counter(), Counter()
    library = Tokenizer.from_file(PATH)
    for i, text, source, lang in data:
        if i is not None and i > first[text]:
            continue
        for version, n in (("words", len(WORD.findall(text))),
                           ("bpe", 1 + len(library.encode(text, add_special_tokens=False).ids))):
            count[source, lang, version] += 1
            tokens[source, lang, version] += n
    want = sorted(((*k, count[k], tokens[k]) for k in count), key=repr)
    assert rows(rollup_documents(docs, PATH, str(tmp_path / "r"))) == want


def test_empty_table(spark, tmp_path):
    assert rollup_documents(awkward(spark, empty=True), PATH, str(tmp_path / "r")).count() == 0


def test_compaction_keeps_totals_and_names(spark, tmp_path):
    rollup = Rollup(spark, str(tmp_path / "r"))
    rollup.compact()
    kind = "source string, lang string, version string, op string, old_tokens bigint, new_tokens bigint"
    for i in range(6):
        changes = spark.createDataFrame([("s", None, "v", "insert", None, i), (None, "l", "v", "delete", 1, None)], kind)
        assert rollup.commit(f"b{i}", changes)
        if i % 2:
            rollup.compact()
        for j in range(i + 1):
            assert not rollup.commit(f"b{j}", changes) if j in (0, i) else True
    assert {tuple(r) for r in rollup.totals().collect()} == {("s", None, "v", 6, 15), (None, "l", "v", -6, -6)}
    assert rollup._since(rollup._base()[0]).count() == 0
