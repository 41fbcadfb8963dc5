"""Verification of near-duplicate candidates, encoding of new words and covering of spans against plain versions."""

import random
import tracemalloc

import numpy as np
import pytest

from tabkit.llm import packing, resemblance, secrets
from tabkit.llm.queries import tokenizer_path


def components(n, pairs):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return [root(i) for i in range(n)]


@pytest.mark.parametrize("seed", range(6))
def test_connect_gives_the_components_of_all_pairs(seed):
    rng = np.random.default_rng(seed)
    base = [rng.integers(0, 2**63, rng.integers(0, 80)).astype(np.uint64) for _ in range(5)] + [np.empty(0, np.uint64)] * 2
    sets = []
    for _ in range(90):
        s = base[rng.integers(0, len(base))]
        s = s[rng.random(len(s)) > rng.choice([0, 0.03, 0.1, 0.3])]
        sets.append(np.unique(np.concatenate([s, rng.integers(0, 2**63, rng.integers(0, 6) if len(s) else 0).astype(np.uint64)])))
    pairs = [(i, j) for i in range(len(sets)) for j in range(i)
             if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))]
    assert resemblance.connect(sets).tolist() == components(len(sets), pairs)
    assert sorted((int(b), int(a)) for x, y in resemblance.similar_pairs(sets) for a, b in zip(x, y)) == sorted(pairs)


def test_words_encoded_together_are_those_encoded_alone(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_WORDS", 300)
    monkeypatch.setattr(packing, "NEW_WORDS", 7)
    rng = random.Random(1)
    letters = ["a", "b", "é", "漢", "\n", "\t", "1", "'", "s", "!", "🤦", " ", "<|endoftext|>", "Ġ"]
    texts = [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(0 if i % 9 == 0 else 1, 6))) for _ in range(rng.randint(0, 60))) for i in range(300)]
    texts += ["", " ", "  ", "a ", " a", "x\n y", "don't  stop", "end \n"]
    encoder = packing.Encoder(tokenizer_path())
    for at in range(0, len(texts), 20):
        part = texts[at:at + 20]
        assert encoder.encode(part) == encoder._whole(part)
    assert len(encoder.known) <= 300 + 20 * 60


def test_remembered_words_are_no_python_objects():
    texts = [" ".join(f"{chr(97 + i % 26)}{chr(97 + j % 26)}é{i}x{j}" for j in range(500)) for i in range(100)]
    encoder = packing.Encoder(tokenizer_path())
    tracemalloc.start()
    assert encoder.encode(texts) == encoder._whole(texts)
    encoder.rests.clear()
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(encoder.known) == 49_900 and held < 4_000_000


def test_letters_are_encoded_apart_from_what_follows():
    rng = random.Random(6)
    parts = ["a", "De", "é", "ǅ", "ß", "ʰ", "\u0301", "ñ÷", "×", "²", "Ⅷ", "ж", "中", "\x00", "\x1c", "\x85", "\xa0", "\u3000", "'s", "'", "'ll", ".", "\n", "\n\n", "_", "{", "`", "@", "7", " "]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 9))) for _ in range(8_000)]
    encoder = packing.Encoder(tokenizer_path())
    assert encoder.cuts_letters and encoder.encode(texts) == encoder._whole(texts)


def test_a_text_full_of_spans_is_swept_once():
    rng = random.Random(2)
    characters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    text = "\n".join(f"password = {''.join(rng.choice(characters) for _ in range(rng.randint(6, 60)))} {''.join(rng.choice(characters) for _ in range(40))}" for _ in range(5_000))
    spans = secrets.find_secrets(text)
    fixed = [(s, e) for s, e, k in spans if k != "entropy"]
    entropy = [(s, e) for s, e, k in spans if k == "entropy"]
    assert len(fixed) >= 4_900 and len(entropy) >= 3_000
    for a, b in entropy[:200]:
        assert not any(s <= a and b <= e for s, e in fixed)


def test_ids_of_any_type(spark):
    text = "one passage of text that several rows of this small table hold in full and with one word more"
    rows = [(None, text), ("b", text), ("a10", text + " here"), ("c", "another text that has nothing in common with the first one"), (None, text + " there")]
    out = resemblance.drop_near_duplicates(spark.createDataFrame(rows, "name string, body string"), "name", "body")
    assert sorted(r["name"] for r in out.collect()) == ["a10", "c"]
    days = spark.createDataFrame([("2024-01-02", text), ("2024-01-01", text)], "day string, body string").selectExpr("cast(day as date) day", "body")
    assert [str(r["day"]) for r in resemblance.drop_near_duplicates(days, "day", "body").collect()] == ["2024-01-01"]


def test_a_task_gives_back_what_it_freed():
    from tabkit.llm.common import give_back

    def held():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096
    small = [bytes(600) for _ in range(100_000)]
    kept = small[::1000]
    small.clear()
    before = held()
    give_back()
    assert len(kept) == 100 and before - held() > 20_000_000
