import public_tokenizers

from gradeledger.llm import bpe, importance, workers


def test_a_task_lets_go_of_what_other_operators_keep():
    content = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
    workers.begin("bpe")
    words = bpe.vocabulary(content)
    workers.begin("bpe")
    assert bpe.vocabulary(content) is words  # its own tasks find it again
    workers.begin("importance")
    importance.gram_buckets(b"one text of some words")
    assert not bpe._LOADED and importance._HASHES
    workers.begin("jaccard")  # an operator that keeps nothing
    assert not importance._HASHES
