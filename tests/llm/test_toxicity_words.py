"""Which words and texts the toxicity model may learn from."""

import math
import re

import numpy as np

from personalens.llm import toxicity
from personalens.llm.common import BYTE_CODE, span_hashes


def word_hash(word):
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(span_hashes(BYTE_CODE[raw], np.array([0]), np.array([len(raw)]))[0])


def name(ending, i):
    return "".join(chr(97 + int(c)) for c in str(i)) + ending


def test_no_sure_word_is_pushed_out(spark):
    """Words of toxic texts alone stay beside common words of a small skew, however many there are of either."""
    rng = np.random.default_rng(4)
    slurs, common = [name("slur", i) for i in range(200)], [name("topic", i) for i in range(300)]
    rows = []
    for i in range(6000):
        y = int(i < 2000)
        words = [w for w, p in zip(common, rng.random(300), strict=True) if p < (0.45 if y else 0.3)]
        rows.append((y, 1.0, " ".join(words + ([slurs[i % 200], slurs[(i + 7) % 200]] if y else []))))
    lexicon = toxicity.choose_lexicon(spark.createDataFrame(rows, "label int, weight double, text string").repartition(4))
    assert {word_hash(w) for w in slurs} <= set(lexicon.tolist())


def test_only_whole_copies_train_as_one(spark):
    footer = " This text is free software and you may pass it on under the terms of its licence."
    texts = ["You idiot." + footer, "You clown." + footer, "You idiot." + footer, "Good day." + footer, "Good night." + footer]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i < 3)) for i in range(5)], "doc_id long, toxic int")
    rows = toxicity.training_rows(docs, marks, "toxic", 1, 5).collect()
    assert sorted((r.label, r.weight, r.text) for r in rows) == sorted(
        [(1, 2.0, texts[0]), (1, 1.0, texts[1]), (0, 1.0, texts[3]), (0, 1.0, texts[4])])


def test_unseen_forms_of_a_stem_are_known(spark):
    """A form never seen in training counts by its stem; a clean word of the same first letters doesn't."""
    rng = np.random.default_rng(5)
    tail = [a + b for a in "aeiouy" for b in "bcdfglmnprst"]
    fill = ["vorgang", "vortrag", "haus", "baum", "stadt"]
    rows = []
    for i in range(1200):
        y = int(i < 300)
        words = [fill[j] for j in rng.integers(0, 5, 12)] + (["vorschimp" + tail[i % 60]] if y else [])
        rows.append((y, 1.0, " ".join(words)))
    train = spark.createDataFrame(rows, "label int, weight double, text string").repartition(4)
    lexicon = toxicity.choose_lexicon(train)
    bags = train.mapInArrow(toxicity._bags(lexicon), "label int, weight double, sentence array<long>, word array<long>").collect()
    model = toxicity.fit(lexicon, *([b[c] for b in bags] for c in ("label", "weight", "sentence", "word")))
    unseen = ["vorschimp" + t for t in tail[60:]]
    score, spans = model.apply([f"Der Baum im Haus. Ein {w}!".encode() for w in unseen] + ["Der Vortrag im Haus. Ein Vorgang!".encode(), b""])
    assert (score[:-2] >= 0.5).all() and (score[-2:] < 0.5).all()
    assert all(s.startswith("17:") for s in spans[:-2])


def brute_force(model_terms, bias, leak, text):
    """The noisy-or of a text, sentence by sentence and letter by letter."""
    alive = 1 - leak
    for sentence in re.split(r"[.!?\n\0]", text):
        words = {"".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in re.findall("[A-Za-z\x80-\U0010ffff]+", sentence)}
        terms = words | {w[:k] + "*" for w in words for k in range(3, min(len(w), 8) + 1)}
        hit = [model_terms[t] for t in terms if t in model_terms]
        if hit:
            alive *= 1 - 1 / (1 + math.exp(-bias - sum(hit)))
    return 1 - alive


def test_scores_are_those_of_a_plain_noisy_or():
    known = {"idiot": 6.0, "trottel*": 5.0, "tro*": 1.5, "été": 3.0, "漢字漢*": 7.5, "ab": 2.5, "übelkeit*": 8.0}
    lexicon = np.array([word_hash(t.rstrip("*")) ^ (int(toxicity.BEGINNING) if t.endswith("*") else 0) for t in known], np.uint64)
    order = np.argsort(lexicon)
    model = toxicity.Model(lexicon[order], np.array(list(known.values()))[order], -7.0, 0.01)
    texts = ["", " \n", "Idiot.", "IDIOT idiot, tro. Idiots!", "Trottelige Trottel\nund été", "漢字漢字 漢字", "ab abc. ab ab Ab été idiot",
             "Übelkeit übelkeiten übelkeit", "troT\0idiot", "x" * 5000 + ". idiot été", "été." * 50, "1idiot2 tr0 \x0b tro"]
    score, _ = model.apply([t.encode() for t in texts])
    assert np.allclose(score, [brute_force(known, -7.0, 0.01, t) for t in texts])
