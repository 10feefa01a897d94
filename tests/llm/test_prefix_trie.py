import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

from tidemark.llm.prefix_trie import conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string, name string, seg int, conv string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    said = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            said[c].append(((turn is not None, turn or 0), tie, (role, text)))
    said = {c: [t for _, _, t in sorted(ts)] for c, ts in said.items()}
    whole = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))  # as in SQL, towards zero
        whole[c] = tuple(said.get(base, [])[:h] + own[h:])
    members, children = defaultdict(list), defaultdict(set)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
            if d:
                children[turns[:d - 1]].add(turns[:d])
    total = {}
    for node in sorted(members, key=len, reverse=True):
        kids = children[node]
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        total[node] = (sum(total[k][0] for k in kids) if kids else 1, (len(members[node]) - 1) * words + sum(total[k][1] for k in kids))
    out = []
    for node, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if whole[c] == node)))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]), *total[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return out


def found(spark, rows):
    given = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    return [tuple(r) for r in conversation_trie(given).select(*COLUMNS).collect()]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def test_against_brute_force(spark):
    r = random.Random(3)
    rows = []
    for c in range(140):
        if c in (20, 60):
            continue  # families without their first conversation
        shared = r.random() < 0.6
        for t in range(r.choice([1, 2, 3, 8, 9, 17])):
            rows.append((c, t, r.choice(["user", "bot"]) if not shared else "user", f"hi {t // 3}" if shared else f"turn {r.randrange(3)} \t of\n{t}"))
    rows += [(200, None, None, None), (200, 1, "user", ""), (200, 1, "user", "tie"), (200, 1, "user", "tie"), (None, 1, "user", "nobody"), (199, 5, "a", "b")]
    rows += [(3, t, "user", f"hi {t // 3}") for t in range(30, 60)] + [(-7, 1, "u", "below zero"), (-20, 0, "u", "zero")]
    assert order(found(spark, rows)) == order(brute(rows))


def test_long_conversations_share_long_prefixes(spark):
    rows = [(c, t, "user", f"word {t % 7} and more") for c, n in ((0, 300), (40, 299), (80, 129), (100, 65), (120, 64), (140, 1)) for t in range(n)]
    rows += [(160, t, "user", f"word {t % 7} and more" if t != 128 else "another way") for t in range(270)]
    assert order(found(spark, rows)) == order(brute(rows))


def test_copies_by_the_thousand_and_an_empty_table(spark):
    rows = [(c * 20, t, "user", f"same {t}") for c in range(1500) for t in range(2)]
    assert order(found(spark, rows)) == order(brute(rows))
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "a", "b")]) == []
