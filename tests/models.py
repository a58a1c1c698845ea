"""Plain Python models of the text and ranking rules, to compare results with."""

import math
import string
from collections import Counter

from lexspark.functions.text import STOPWORDS

SPACES = " \t\n\x0b\f\r"


def tokens(text):
    words, word = [], ""
    for char in (text or "") + " ":
        if char not in SPACES:
            word += char
            continue
        bare = "".join(c.lower() if c in string.ascii_uppercase else c for c in word if c not in string.punctuation)
        if bare and bare not in STOPWORDS:
            words.append(bare)
        word = ""
    return words


def index(docs):
    postings = {}
    for doc_id, text in docs:
        words = tokens(text)
        for word, n in Counter(words).items():
            postings[doc_id, word] = n / len(words)
    return postings


def idf(postings):
    total = len({d for d, _ in postings})
    counts = Counter(w for _, w in postings)
    return {w: math.log(total / (n + 1)) for w, n in counts.items()}


def search(query, postings, weights, k=3, dedupe=False):
    asked = tokens(query)
    repeats = {w: 1 for w in asked} if dedupe else Counter(asked)
    scores = {}
    for (doc_id, word), tf in postings.items():
        if word in repeats:
            scores[doc_id] = scores.get(doc_id, 0.0) + repeats[word] * tf * weights.get(word, 0.0)
    ranked = [(round(s / len(asked), 8), d) for d, s in scores.items()]
    return [(d, s) for s, d in sorted(ranked, key=lambda r: (-r[0], r[1]))[:k]]
