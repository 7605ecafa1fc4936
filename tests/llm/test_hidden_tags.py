"""Hidden tags without an end tag."""

import pytest

from corpusmap.llm import extract

ARTICLE = "<article><h1>Big</h1><p>The text stays.</p></article>"


@pytest.mark.parametrize("tag", sorted(extract.HIDDEN - extract.RAW))
def test_unclosed_hidden_tag(tag):
    page = f"<html><head><title>x</title></head><body><div><{tag}>gone</div>{ARTICLE}<{tag}>late</{tag}></body></html>"
    texts = [b.text for b in extract.blocks(page)]
    assert texts[-2:] == ["Big", "The text stays."] and (tag == "head" or "gone" not in texts)


def test_hidden_tags():
    texts = lambda page: [b.text for b in extract.blocks(page)]
    for start in ("<html><head><title>x</title><body>", "<head><noscript><link><body>", "<head><meta>", "<svg><g>no"):
        assert texts(start + ARTICLE) == ["Big", "The text stays."]
    assert texts("<div><svg><foreignObject><div>no</div></foreignObject></svg>a<template><div><template>no</template></div>no</template>b</div>") == ["ab"]
    assert texts("<p>a<script>if (1 < 2) '<p>'</script>b<title>" + ARTICLE) == ["ab"]
