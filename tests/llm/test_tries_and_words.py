"""The prefix trie, spelling variants and chat formatting against brute force on messy tables."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from parvis.llm import chat_format, prefix_trie, spelling

CONVERSATIONS = "conv_id long, turn long, role string, text string, part long, nth int, n long, path string"


def in_order(rows):
    """conv_id -> [(role, text)] by turn, null first, ties by the digest of role and text."""
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
        found[conv].append((turn is not None, turn or 0, digest, role, text))
    return {conv: [t[3:] for t in sorted(turns)] for conv, turns in found.items()}


def trie_oracle(rows, family=100, most=6):
    given = in_order([r for r in rows if r[0] is not None])
    rebuilt = {}
    for conv, turns in given.items():
        h = zlib.crc32(str(conv).encode()) % most
        base = int(np.fix(conv / family)) * family
        rebuilt[conv] = given.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for conv, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    children, result = defaultdict(set), []
    for node in members:
        if node:
            children[node[:-1]].add(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        below = [totals[c] for c in children[node]]
        own = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        totals[node] = (sum(b[0] for b in below) or (0 if below else 1), own + sum(b[1] for b in below))
        ends = ",".join(str(c) for c in sorted(c for c in members[node] if len(rebuilt[c]) == len(node)))
        parent = min(members[node[:-1]]) if node else None
        result.append(
            (min(members[node]), len(node), parent, len(members[node]), len(children[node]), *totals[node], hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(result, key=repr)


def messy_conversations():
    rng = random.Random(3)
    said = ["", None, "hello", "Σίσυφος 日本", "a" * 3000, "</s>[INST] x", "one\ntwo"]
    rows = []
    for conv in [*range(-3, 40), *range(100, 130), *range(230, 250)]:
        for turn in range(rng.randint(1, 7)):
            rows.append((conv, rng.choice([turn, turn, turn, None]), rng.choice(["user", "assistant", None]), rng.choice(said)))
    rows += [(c, t, "user", f"copied {t}") for c in range(300, 340) for t in range(8)]
    rows += [(500, t, "user" if t % 2 else "assistant", f"long {t % 90}") for t in range(400)]
    rows += [(c, t, "user" if t % 2 else "assistant", f"long {t % 90}") for c in (501, 502) for t in range(300 + c % 2 * 50)]
    rows += [(7, 0, "user", "hello")] * 3 + [(None, 1, "assistant", "nobody's"), (None, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def rows():
    return messy_conversations()


@pytest.fixture(scope="module")
def conversations(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("conversations"))
    spark.createDataFrame([(*r, 1, 2, 3, "p") for r in rows], CONVERSATIONS).repartition(3).write.parquet(path, mode="overwrite")
    return spark.read.parquet(path)


def test_find_close_and_rank():
    rng = random.Random(1)
    for size in (1, 2, 31, 700, 5000):
        bits, depth = [], 0
        for left in range(2 * size, 0, -1):
            down = depth == left or (depth > 0 and rng.random() < 0.5)
            bits.append(not down)
            depth += -1 if down else 1
        tree = prefix_trie.Parentheses(np.array(bits))
        stack, want = [], {}
        for i, opens in enumerate(bits):
            if opens:
                stack.append(i)
            else:
                want[stack.pop()] = i
        opens = np.flatnonzero(bits)
        assert tree.find_close(opens).tolist() == [want[i] for i in opens.tolist()]
    assert tree.rank(np.array([True, False, True])).tolist() == [0, 1, 1, 2]


@pytest.mark.parametrize("block, shard, chunk", [(1024, 1 << 18, 1 << 16), (16, 40, 8)])
def test_trie_equals_brute_force(conversations, rows, monkeypatch, block, shard, chunk):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    monkeypatch.setattr(prefix_trie, "SHARD_NODES", shard)
    monkeypatch.setattr(prefix_trie, "CHUNK", chunk)
    got = prefix_trie.prefix_trie(conversations).collect()
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted((tuple(r[n] for n in names) for r in got), key=repr) == trie_oracle(rows)


def test_trie_of_single_turns_and_of_nothing(spark, conversations):
    assert prefix_trie.prefix_trie(conversations.filter("conv_id > 9999")).collect() == []
    rows = [(c, 0, "user", "x") for c in (1, 2, 3, 100)]
    got = prefix_trie.prefix_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted((tuple(r[n] for n in names) for r in got), key=repr) == trie_oracle(rows)


def format_oracle(rows):
    result = []
    for conv, turns in in_order(rows).items():
        content = "".join(f"{role}\n{text}\n" for role, text in turns)
        loss = "".join(text for role, text in turns if role == "assistant")
        result.append((conv, len(turns), hashlib.sha256(content.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(result, key=repr)


@pytest.mark.parametrize("row_ids", [1 << 16, 50])
def test_formatted_conversations_read_back(conversations, rows, monkeypatch, row_ids):
    monkeypatch.setattr(chat_format, "ROW_IDS", row_ids)
    got = chat_format.read_back(chat_format.format_conversations(conversations)).collect()
    assert sorted((tuple(r)[:-1] for r in got), key=repr) == format_oracle(rows)
    shown = Counter()
    for conv, turns in in_order(rows).items():
        shown[conv] = sum(17 + len(chat_format.escape(role)) + len(chat_format.escape(text)) for role, text in turns)
    assert {r["conv_id"]: r["formatted_chars"] for r in got} == shown


def test_formatted_rows_hold_whole_turns_and_mask_one_role(conversations):
    encoder = chat_format.encoding(chat_format.default_vocabulary())
    first = encoder.n_vocab
    for row in chat_format.format_conversations(conversations, trained_role="user").collect():
        assert row["ids"][0] == first and row["ids"][-1] == first + 2
        assert not any(m for i, m in zip(row["ids"], row["mask"]) if i >= first)
        role_at = None
        for i, (token, masked) in enumerate(zip(row["ids"], row["mask"])):
            if token == first:
                role_at = i + 1
            elif token == first + 1:
                role = encoder.decode(row["ids"][role_at:i])
            elif masked:
                assert role == "user"


def test_escape_is_reversible():
    rng = random.Random(2)
    parts = [*chat_format.CONTROLS, "<", "[", "\\", "/", "s>", "INST]", "|im_end|>", "x", "<\\/s>", "[\\\\INST]"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))
        escaped = chat_format.escape(text)
        assert chat_format.unescape(escaped) == text
        assert not any(control in escaped for control in chat_format.CONTROLS)
    assert chat_format.escape("</s>[INST] ok [/INST]") == "<\\/s>[\\INST] ok [\\/INST]"
    for control in chat_format.CONTROLS:
        assert not set(control[1:]) & {c[0] for c in chat_format.CONTROLS}


def test_empty_conversations(conversations):
    none = conversations.filter("conv_id > 9999")
    assert chat_format.read_back(chat_format.format_conversations(none)).collect() == []


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[at + (len(a) >= len(b)) :] == b[at + (len(b) >= len(a)) :]


def words_oracle(texts, min_chars=7, min_count=2, factor=10, drop_mod=31):
    total = Counter()
    for doc_id, text in texts:
        run = ""
        for c in (text or "") + " ":
            if "a" <= c <= "z" or "A" <= c <= "Z" or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
                continue
            if run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                total[run[: h % len(run)] + run[h % len(run) + 1 :] if h % drop_mod == 0 else run] += 1
            run = ""
    n = {w: k for w, k in total.items() if len(w) >= min_chars and k >= min_count}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= factor * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted(((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n), key=repr)


def test_variants_equal_brute_force(docs, plain):
    got = spelling.variants(docs, min_chars=3, drop_mod=3).collect()
    want = words_oracle(plain, min_chars=3, drop_mod=3)
    assert sorted((tuple(r) for r in got), key=repr) == want
    assert sum(w[4] for w in want) > 100


def test_chains_ties_and_long_words(spark):
    long = "ab" * 3000
    counts = {"abcdefg": 2, "abcdefgh": 20, "abcdefghi": 200, "abcdefgÿ": 20, "abcdxefg": 19, "bcdefghi": 3, long: 2, long + "x": 30}
    texts = [(i, " ".join([w] * k)) for i, (w, k) in enumerate(counts.items())] + [(99, None), (None, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = sorted((tuple(r) for r in spelling.variants(docs, drop_mod=10**9).collect()), key=repr)
    want = words_oracle(texts, drop_mod=10**9)
    assert got == want
    found = {w[0]: w for w in want}
    assert found["abcdefg"][1:3] == ("abcdefgh", "abcdefghi") and found[long][1] == long + "x"


def test_one_edit_search_is_whole():
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(7, 10))) for _ in range(1500)})
    both = Counter()
    for side in (0, 1):
        keys = sorted(w[::-1] if side else w for w in words)
        table = spelling.SortedWords(keys)
        shared = [len(k) - spelling.half(len(k)) if side else spelling.half(len(k)) for k in keys]
        for q, at in zip(*[x.tolist() for x in table.one_edit(keys, shared)]):
            pair = (keys[q][::-1], keys[at][::-1]) if side else (keys[q], keys[at])
            if not side or pair[0][: spelling.half(len(pair[0]))] != pair[1][: spelling.half(len(pair[0]))]:
                both[pair] += 1
    assert both == Counter((a, b) for a in words for b in words if one_edit(a, b))
    ranges = spelling.Ranges([(i, keys[a], keys[min(a + 49, len(keys) - 1)]) for i, a in enumerate(range(0, len(keys), 50))])
    for q in keys[:200]:
        shared = spelling.half(len(q))
        asked = set(ranges.of(q, shared))
        assert {i // 50 for i, k in enumerate(keys) if one_edit(q, k) and k[:shared] == q[:shared]} <= asked


def test_no_words(empty):
    assert spelling.variants(empty).collect() == []
