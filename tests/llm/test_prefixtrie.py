import hashlib
import random
import re
import zlib

import pytest

from kilowatch.llm import prefixtrie
from tests.llm.fixtures import frame, with_clashes

CONVERSATIONS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """The nodes by plain prefixes of whole lists."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            r, x = role or "", text or ""
            tie = hashlib.md5(f"{len(r)}:{r}{x}".encode()).hexdigest()
            own.setdefault(c, []).append(((turn is not None, turn or 0, tie), (r, x)))
    own = {c: [t for _, t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        kin = c - (abs(c) % 20) * (1 if c > 0 else -1)
        built[c] = tuple(own.get(kin, [])[:h] + turns[h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)

    def subtree(node):
        todo = [node]
        while todo:
            at = todo.pop()
            yield at
            todo += children.get(at, [])

    out = []
    for node, convs in members.items():
        below = list(subtree(node))
        words = {v: len(re.findall(r"[^\x20\x09-\x0D]+", v[-1][1])) if v else 0 for v in below}
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(node))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children.get(node, [])),
            sum(1 for v in below if v not in children), sum((len(members[v]) - 1) * words[v] for v in below),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def check(spark, rows, parts=5):
    df = with_clashes(frame(spark, rows, CONVERSATIONS), "depth", "pos", "block", "part", "s1", "words", "digest", "tie").repartition(parts)
    got = [tuple(r) for r in prefixtrie.conversation_trie(df).select(*COLUMNS).collect()]
    assert sorted(got, key=repr) == brute(rows)


def random_rows(seed, n, most=9):
    rng = random.Random(seed)
    texts = ["a b", "c", "", None, "hello  there\tyou", "é ü"]
    roles = ["user", "assistant", None, ""]
    rows = []
    for c in rng.sample(range(-60, 200), n):
        for t in range(rng.randint(1, most)):
            rows.append((c, rng.choice((t, t, t, None, 0)), rng.choice(roles[:2] if t else roles), rng.choice(texts[:3] if t < 3 else texts)))
    rows += rng.sample(rows, 10)  # repeated rows
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    check(spark, random_rows(seed, 90) + [(None, 1, "user", "of no conversation")])


def test_long_and_common_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "BLOCK", 4)
    rows = [(c, t, "user", f"same {t}") for c in range(1, 400) for t in range(5)]  # one sequence, many ends
    rows += [(1000, t, "user", f"same {t}" if t < 300 else f"own {t}") for t in range(700)]
    rows += [(1020, t, "user", f"same {t}") for t in range(310)] + [(2000, 0, None, None)]
    check(spark, rows)


def test_turns_of_a_long_conversation_spread(spark):
    rows = spark.range(20_000).selectExpr("7L AS conv_id", "id AS turn", "'user' AS role", "'x' AS text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one range
    numbered = prefixtrie.numbered(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert numbered.select("part").distinct().count() > 1
    assert numbered.agg({"pos": "max"}).first()[0] == 20_000 == numbered.select("pos").distinct().count()


def test_turnless_and_empty(spark):
    assert prefixtrie.conversation_trie(frame(spark, [], CONVERSATIONS)).collect() == []
    # Conversations whose own turns are all replaced by those of an absent one are turnless.
    gone = [c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3]
    check(spark, [(c, t, "user", "x y") for c in gone for t in range(2)])
