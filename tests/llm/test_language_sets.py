"""Language sets have no bound; the mixture equals plain expectation-maximisation."""
import math
import random

import numpy as np
import pyarrow as pa

from lifetab.llm import language_id

OWN = {"aa": ["tion", "the", "ing", "wh"], "bb": ["ñar", "que", "ción", "el"], "cc": ["sch", "ung", "der", "tz"],
       "dd": ["kko", "yys", "ään", "vi"], "ee": ["rzy", "szcz", "ów", "nie"]}


def text(lang, i, words=30):
    r = random.Random(f"{lang}{i}")
    return " ".join("".join(r.choices(OWN[lang], k=r.randrange(1, 4))) for _ in range(words))


def plain_em(like, allowed):
    """(shares, log likelihood) of one document's words, by the definition."""
    shares = [a / sum(allowed) for a in allowed]
    for _ in range(language_id.ROUNDS):
        total = [language_id.PRIOR * a for a in allowed]
        for word in like:
            joint = [s * w for s, w in zip(shares, word)]
            total = [t + j / sum(joint) for t, j in zip(total, joint)]
        shares = [t / sum(total) for t in total]
    return shares, sum(math.log(sum(s * w for s, w in zip(shares, word))) for word in like)


def test_sets_and_shares(make):
    docs = make([(k * 100 + i, text(x, i), x, "a") for k, x in enumerate(OWN) for i in range(30)])
    names, logp = language_id.learn(docs)
    assert names == sorted(OWN)
    mixes = [["aa"], ["aa", "bb"], ["aa", "bb", "cc", "dd"], list(OWN), ["ee", "ee", "ee", "dd"]]
    texts = [" ".join(text(x, 50 + i) for i, x in enumerate(m)) for m in mixes]
    rows, shares, chosen = language_id.language_sets(pa.array(["", *texts]), logp)
    assert rows.tolist() == [1, 2, 3, 4, 5]
    assert [{names[j] for j in np.flatnonzero(c)} for c in chosen] == [set(m) for m in mixes]
    best, _ = language_id.infer(pa.array(["", *texts]), logp)
    assert best[0] == -1 and names[best[5]] == "ee"
    for t, s, c in zip(texts, shares, chosen):
        grams, starts, _ = language_id.letter_grams(pa.array([t]))
        ll = np.add.reduceat(logp[grams], starts, axis=0).astype(float)
        like = np.exp(ll - ll.max(1, keepdims=True)).tolist()
        want, whole = plain_em(like, [1] * 5)
        np.testing.assert_allclose(s, want, atol=1e-4)
        order, best_set, value = sorted(range(5), key=lambda j: -want[j]), None, -math.inf
        for k in range(1, 6):
            part, fit = plain_em(like, [int(j in order[:k]) for j in range(5)])
            fit -= (k - 1) * .5 * math.log(len(like) + 1)
            if fit <= value:
                break
            best_set, value = part, fit
        assert set(np.flatnonzero(best_set)) == set(np.flatnonzero(c))
