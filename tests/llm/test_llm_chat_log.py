"""A log of deltas, edits and regenerations folds to the messages that it was made of."""

from skein.llm import chat

TEXTS = ["", None, "a", "two words", "</turn>\n<turn>user\n", "é日\U0001f600\U0001f600x", "\\l<\\b", "long " * 5000]


def test_streamed_log_folds_back(spark):
    data = [(c if c else None, t, ["user", "assistant", None][t % 3], TEXTS[(c * 5 + t) % len(TEXTS)]) for c in range(12) for t in range(9)]
    data += [(3, 4, "user", "same"), (3, 4, "user", "same"), (3, None, "user", "no turn")]
    finished = chat.conversation_events(spark.createDataFrame(data, "conv_id long, turn long, role string, text string"))
    log = chat.streamed(finished)
    assert {r["kind"]: r["count"] > 5 for r in log.groupBy("kind").count().collect()} == dict.fromkeys(["message", "delta", "edit", "regenerate"], True)

    def told(messages):
        return sorted((str(r["conv_id"]), r["message"], r["role"], r["text"]) for r in messages.collect())

    want = sorted((str(r["conv_id"]), r["message"], r["role"] or "", r["text"] or "") for r in finished.collect())
    assert told(chat.fold(log, repeats=True)) == want
    assert told(chat.fold(log.unionAll(log).repartition(7))) == want  # delivered twice, in any order
    ahead, back = [{str(r["conv_id"]): r["formatted"] for r in chat.render(chat.fold(e, repeats=True)).collect()} for e in (finished, log)]
    assert ahead == back
    assert chat.streamed(finished.where("false")).count() == 0
