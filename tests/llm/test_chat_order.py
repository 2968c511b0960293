"""Turns that tie in conversation, turn and role stand in the order of their texts across partitions."""

import random

from martforge.llm.chat import format_chats


def test_ties_in_order_of_text(spark):
    rnd = random.Random(9)
    texts = [f"t{rnd.randrange(10**8):08d}" for _ in range(3000)]
    keys = ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")
    old = [spark.conf.get(k) for k in keys]
    try:
        for k, v in zip(keys, ("false", "8")):
            spark.conf.set(k, v)
        turns = spark.createDataFrame([(1, 1, "user", t) for t in texts], "conv_id long, turn int, role string, text string")
        rows = format_chats(turns.repartition(4)).select("place", "rendered").collect()
    finally:
        for k, v in zip(keys, old):
            spark.conf.set(k, v)
    got = "".join(r.rendered for r in sorted(rows, key=lambda r: r.place))
    assert [x for x in got.replace("<|im_end|>", "").split("\n") if x.startswith("t")] == sorted(texts)
