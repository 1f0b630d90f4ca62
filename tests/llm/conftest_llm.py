"""Plain helpers of the tests in this folder."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PAGES = "page_id long, url string, html string"


def odd_texts() -> list:
    """Texts that every operator has to take: null, empty, no word, ties, odd characters, very long."""
    return [None, "", " ", "\n\n\t", "a", "a", "A b", "x\x00y", "é中😀 ▁ ▁▁", "</s> <unk> <|endoftext|>", "\x85\xa0 w",
            "word " * 5000, "wörd" * 20000, "#$%& | <>\n#$%& | <>"]


def rows_of(texts) -> list:
    return [(i, t, "en" if i % 2 else None, "s", None) for i, t in enumerate(texts)]
