"""Made-up texts for the classifiers' tests."""

import random

NICE = [f"{a}{b}" for a in ("sun", "moon", "tree", "lake", "hill", "bird", "road", "wind") for b in ("ly", "ing", "ed", "er", "en", "s", "ish", "y")]
RUDE = ["blorg", "snark", "vexo", "grubb", "zilch"]


def clean_text(i, n=60):
    r = random.Random(i)
    return "\n".join(" ".join(r.choice(NICE) for _ in range(n // 4)).capitalize() + "." for _ in range(4))


def toxic_text(i):
    words = clean_text(i).split()
    r = random.Random(-i)
    for _ in range(4):
        words[r.randrange(len(words))] = r.choice(RUDE)
    return " ".join(words)


def junk_text(i):
    words = clean_text(i).split()
    return " ".join(w + "***" for w in words) if i % 2 else " ".join(w.upper() + "!!" for w in words)
