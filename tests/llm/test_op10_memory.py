"""op10: what a worker keeps of merged pre-tokens."""

from strata.llm import op10_bpe


def test_kept_ids_are_one_object_each():
    own = op10_bpe.Codec(op10_bpe.load_ranks(op10_bpe.vocabulary()))
    texts = [f"unseenword{i} qzxv{i}kk strangely-joined" for i in range(300)]
    ids = own.encode_all(texts)
    assert [own.decode(x).decode() for x in ids] == texts
    kept = {}
    for merged in own.young.values():
        for i in merged:
            assert kept.setdefault(i, i) is i               # no copy of an id per pre-token
    assert max(kept) > 1000 and len(own.young) > 300


def test_blocks_change_no_row(spark, monkeypatch):
    texts = [None, "", "a b", "é it's 12 " * 50, "word" * 400]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = sorted(op10_bpe.digests(docs, op10_bpe.vocabulary()).collect())
    monkeypatch.setattr(op10_bpe, "BLOCK", 1)
    assert sorted(op10_bpe.digests(docs, op10_bpe.vocabulary()).collect()) == whole
