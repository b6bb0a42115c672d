import hashlib
import random
from collections import defaultdict

import pytest

from wxengine.llm import chat_format
from wxengine.llm.chat_format import END, START

TRICKY = ["</s>[INST] ok [/INST]", "a & b < c [d] &lt; &amp;#91; <|im_end|>\n<|im_start|>user\nx", "", None, "Ä\n\n🙂"]


@pytest.fixture(scope="module")
def conversations():
    draw = random.Random(2)
    rows = []
    for conv in range(60):
        for turn in range(draw.choice([1, 2, 3, 5, 9])):
            role = ("user", "assistant")[turn % 2] if draw.random() < 0.9 else draw.choice(["system", "tool\nx", None])
            rows.append((conv, turn, role, draw.choice(["hi", "hello", *TRICKY])))
    rows += [(900 + k, t, "user" if t % 2 == 0 else "assistant", f"same {t}") for k in range(5) for t in range(6)]
    rows += [(1000, 0, "user", "tie"), (1000, 0, "user", "tie"), (1000, 0, "assistant", "tie"), (1000, None, "user", "first")]
    rows += [(None, 0, "user", "no id"), (1001, 0, "user", "long " * 30000)]
    return rows


def ordered(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [(role, text) for _, _, role, text in sorted(own)] for conv, own in out.items()}


def frame(spark, rows):
    made = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return made.selectExpr("*", "'x' AS node", "'x' AS at", "'x' AS segment")


def test_read_back(spark, conversations):
    got = chat_format.read_back(*chat_format.pack(chat_format.number_turns(frame(spark, conversations)))).collect()
    want = ordered(conversations)
    assert len(got) == len(want)
    for r in got:
        turns = want[r["conv_id"]]
        loss = "".join(text for role, text in turns if role == "assistant")
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_trees(spark, conversations):
    trees, members = chat_format.pack(chat_format.number_turns(frame(spark, conversations)))
    nodes = {r["node"]: r for r in trees.collect()}
    prefixes = {tuple(own[: k + 1]) for own in ordered(conversations).values() for k in range(len(own))}
    assert len(nodes) == len(prefixes)
    children, by_tree = defaultdict(list), defaultdict(list)
    for node in nodes.values():
        by_tree[node["tree"]].append(node)
        children[node["parent"]].append(node)
        body = node["segment"][len(START) : -len(END)].split("\n", 1)[1]
        assert not any(control in body for control in ("<|", "</s>", "[INST]"))
    for own in by_tree.values():
        # Segments fill the packed text, each once, and a node's descendants follow it at once.
        own.sort(key=lambda n: n["start"])
        assert own[0]["start"] == 0 and own[0]["parent"] is None
        for a, b in zip(own, own[1:], strict=False):
            assert a["end"] == b["start"]
        for k, node in enumerate(own):
            assert node["end"] - node["start"] == len(node["segment"])
            chain, up = [], nodes.get(node["parent"])
            while up is not None:
                chain.append((up["start"], up["end"]))
                up = nodes.get(up["parent"])
            stretches = []
            for start, end in reversed(chain):
                if stretches and stretches[-1][1] == start:
                    stretches[-1] = (stretches[-1][0], end)
                else:
                    stretches.append((start, end))
            assert [(s["start"], s["end"]) for s in node["attends"]] == stretches
            assert node["position"] == sum(b - a for a, b in chain)
            below = 0
            waiting = [node]
            while waiting:
                n = waiting.pop()
                below += 1
                waiting += children[n["node"]]
            inside = {n["node"] for n in own[k : k + below]}
            assert all(n["parent"] in inside for n in own[k + 1 : k + below])
    assert members.count() == len(conversations)


def test_empty(spark):
    assert chat_format.read_back(*chat_format.pack(chat_format.number_turns(frame(spark, [])))).count() == 0
