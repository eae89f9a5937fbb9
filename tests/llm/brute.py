"""Plain Python versions of what several tests compare with."""

import re

from wayside.llm import spans


def words(text):
    return re.findall(spans.WORD, text or "")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_shingles(text, size=5):
    lower = words(lowered(text))
    if not lower:
        return set()
    return {tuple(lower[i : i + size]) for i in range(max(1, len(lower) - size + 1))}
