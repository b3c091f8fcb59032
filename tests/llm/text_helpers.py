"""Rows with the awkward cases every operator has to bear."""

from __future__ import annotations

SF = "/root/testdata/sf0.001"
AWKWARD = "doc_id long, text string, lang string, source string, n_chars long, size long, row string"


def awkward_rows() -> list[tuple]:
    long_text = "\n".join(f"Line number {i % 700} of the Long text, it is." for i in range(6000))
    texts = [
        None,
        "",
        " \t\n ",
        "One",
        "two words",
        long_text,
        long_text + "\nand more. It is so.",
        "The same long line here.\nshort\n  THE SAME long line here.\t\n\n",
        "The same long line here.\nshort",
        "The same long line here.\nshort",
        "released under the MIT license. cc by nc cc by nc | Apache License, Version 2.0",
        " É x É ÉÉ | a | b | c\nx\x0by\x0cz <|endoftext|> ñ",
        "a b c " * 60,
    ]
    rows = [(i, t, "en", f"s{i % 3}", 1, 7, "x") for i, t in enumerate(texts)]
    rows += [(None, "The same long line here.\nof no one", None, None, None, None, None)]
    rows += [(3, "Again the third id, with the same long line here.", "en", None, 5, 7, "x")]
    rows += [rows[8], rows[8]]
    return rows
