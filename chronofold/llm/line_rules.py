"""Quality rules, line first: lines that fail a rule go, then texts that lose too much of themselves.

Everything is an expression on the text of one row: no shuffle, no Python, and texts of any
length take time in proportion (the search for repeated words sorts, so a little more).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from chronofold.functions import col_of

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MOST_REPEATED_PERCENT = 50
# A line's rules.
END = r"""[.!?…。！？:;"'”’»)\]]\s*$"""
MOST_SYMBOLS_PER_100_WORDS = 20
MOST_SHOUTS_PER_100_WORDS = 30
SHOUT = r"[!?]{2,}"
# What such lines begin with or hold in English, German, French and Spanish. Letters beyond ASCII are written in
# both cases, and word ends by letter classes, as engines differ in how far they fold case and know such letters.
NAVIGATION = (
    r"(?i)^\s*(home|menu|skip to|back to top|next|previous|login|log in|sign in|sign up|share|search"
    r"|startseite|men(ü|Ü)|zum inhalt|nach oben|weiter|zur(ü|Ü)ck|anmelden|registrieren|teilen|suche"
    r"|accueil|aller au contenu|haut de page|suivant|pr(é|É)c(é|É)dent|connexion|se connecter|s'inscrire|partager|rechercher"
    r"|inicio|men(ú|Ú)|saltar al contenido|volver arriba|siguiente|anterior|iniciar sesi(ó|Ó)n|registrarse|compartir|buscar)"
    r"($|[^\p{L}\p{N}_].{0,39}$)"
)
BOILERPLATE = (
    r"(?i)(cookie policy|accept (all )?cookies|enable javascript|all rights reserved|terms of (use|service)"
    r"|privacy policy|click here|subscribe to our|lorem ipsum"
    r"|cookie-richtlinie|cookies akzeptieren|javascript aktivieren|alle rechte vorbehalten|nutzungsbedingungen"
    r"|datenschutzerkl(ä|Ä)rung|hier klicken|accepter (tous )?les cookies|activer javascript"
    r"|tous droits r(é|É)serv(é|É)s|conditions d'utilisation|politique de confidentialit(é|É)|cliquez ici"
    r"|aceptar (todas )?las cookies|activar javascript|todos los derechos reservados|condiciones de uso"
    r"|pol(í|Í)tica de privacidad|haga clic aqu(í|Í))"
)
# A longer line may say such a thing in passing; it is no boilerplate for that.
LONGEST_BOILERPLATE = 200
# A text is rejected when less than this share of its letters is in lines that pass.
LEAST_KEPT_PERCENT = 50


def words_of(text: Column) -> Column:
    """The words of a text; none for a null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """How many words lie in a window of three that is found twice or more in the text.

    Windows are compared by a 64-bit hash. Equal hashes are neighbours once sorted; texts
    without any, the common case, stop there.
    """
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def windows(h: Column) -> Column:
        at = lambda i: F.get(h, i)
        return F.when(
            F.size(h) >= 4,
            F.transform(
                F.slice(h, 1, F.greatest(F.size(h) - 2, F.lit(0))),
                lambda x, i: F.xxhash64(x, at(i + 1), at(i + 2)),
            ),
        ).otherwise(F.array().cast("array<bigint>"))

    def starts(w: Column) -> Column:
        """Positions, in order, of windows that are found more than once."""
        placed = F.array_sort(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return with_value(
            placed,
            lambda p: F.sort_array(
                F.transform(
                    F.filter(
                        p,
                        lambda x, i: ((i > 0) & (F.get(p, i - 1)["h"] == x["h"]))
                        | ((i < F.size(p) - 1) & (F.get(p, i + 1)["h"] == x["h"])),
                    ),
                    lambda x: x["i"],
                )
            ),
        )

    def covered(s: Column) -> Column:
        """Words in windows of three that begin at the given positions."""
        return F.aggregate(
            F.transform(s, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(s, i + 1) - x, F.lit(3)))),
            F.lit(0).cast("long"),
            lambda total, x: total + x,
        )

    return with_value(
        hashes,
        lambda h: with_value(
            windows(h),
            lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(
                with_value(starts(w), covered)
            ),
        ),
    )


def with_value(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def symbols_in(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SYMBOLS)).cast("long")


def line_passes(line: Column) -> Column:
    """Whether a line with words passes: it ends like a sentence, is not made of symbols or
    shouts, and is neither navigation nor boilerplate, in any of four languages."""
    n = F.regexp_count(line, F.lit(WORD))
    return (
        line.rlike(END)
        & (symbols_in(line) * 100 <= n * MOST_SYMBOLS_PER_100_WORDS)
        & (F.regexp_count(line, F.lit(SHOUT)) * 100 <= n * MOST_SHOUTS_PER_100_WORDS)
        & ~line.rlike(NAVIGATION)
        & ((F.char_length(line) > LONGEST_BOILERPLATE) | ~line.rlike(BOILERPLATE))
    )


def letters_in(line: Column) -> Column:
    return F.char_length(F.regexp_replace(line, SPACES, "")).cast("long")


def clean_lines(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the counts of its texts, ``cleaned`` (the lines that pass) and ``kept``.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed, kept
    (boolean), cleaned (string, joined by a line feed). A text fails the base rules with under
    50 words, or with over half of them in repeated windows of three; it is kept if it passes
    these and its passing lines hold at least half of its letters. A null or
    empty text has no words and is not kept. Rows are judged one by one: ties and repeated rows
    don't matter. Columns with the name of an added one are replaced.
    """
    content = F.coalesce(col_of(text), F.lit(""))
    worded = F.filter(F.split(content, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    passing = F.filter(F.col("_rules_lines"), line_passes)
    out = (
        df.withColumns({"_rules_words": words_of(content), "_rules_lines": worded})
        .withColumn("_rules_passing", passing)
        .withColumns({
            "n_words": F.size("_rules_words").cast("long"),
            "word_chars": F.char_length(F.array_join("_rules_words", "")).cast("long"),
            "n_symbols": symbols_in(content),
            "n_dup_lines": (F.size("_rules_lines") - F.size(F.array_distinct("_rules_lines"))).cast("long"),
            "n_repeat_words": repeated_words(F.col("_rules_words")),
            "cleaned": F.array_join("_rules_passing", "\n"),
        })
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED_PERCENT
    )
    enough = letters_in(F.col("cleaned")) * 100 >= F.col("word_chars") * LEAST_KEPT_PERCENT
    return (
        out.withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & enough)
        .drop("_rules_words", "_rules_lines", "_rules_passing")
    )
