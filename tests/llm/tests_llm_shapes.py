"""Shapes that every operator must take."""

#: Shapes that every operator must take: null, empty, blanks, long, repeated, non-ASCII.
ODD_TEXTS = [
    None,
    "",
    " \n\t ",
    "a",
    "one two three four five six",
    "one two three four five six",
    "word " * 30_000,
    "É" * 100 + " ǅ ́ 中文 🙂   x",
    "<|endoftext|> it's <|startoftext|>",
    "#" * 200,
]
