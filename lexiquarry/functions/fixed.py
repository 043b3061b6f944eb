"""Word lists and character tables that decide results."""

from __future__ import annotations

import unicodedata

# English stop words used before keyword selection. Contractions are listed in the
# form they have once punctuation is gone.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s
t can will just don should now d ll m o re ve y ain aren couldn didn doesn hadn hasn haven isn ma
mightn mustn needn shan shouldn wasn weren won wouldn
""".split()

# Stop words of the English query analyser.
ANALYZER_STOP_WORDS = """
a an and are as at be but by for if in into is it no not of on or such that the their then there
these they this to was will with
""".split()

# Noun endings and what replaces them when looking for a base form.
NOUN_SUFFIX_RULES = [
    ("s", ""),
    ("ses", "s"),
    ("ves", "f"),
    ("xes", "x"),
    ("zes", "z"),
    ("ches", "ch"),
    ("shes", "sh"),
    ("men", "man"),
    ("ies", "y"),
]

# Irregular English plurals tried besides the rules; callers can pass their own table.
NOUN_EXCEPTIONS = [
    ("analyses", "analysis"),
    ("bacteria", "bacterium"),
    ("children", "child"),
    ("crises", "crisis"),
    ("criteria", "criterion"),
    ("data", "datum"),
    ("diagnoses", "diagnosis"),
    ("feet", "foot"),
    ("geese", "goose"),
    ("hypotheses", "hypothesis"),
    ("indices", "index"),
    ("lice", "louse"),
    ("matrices", "matrix"),
    ("mice", "mouse"),
    ("nuclei", "nucleus"),
    ("oxen", "ox"),
    ("phenomena", "phenomenon"),
    ("strata", "stratum"),
    ("teeth", "tooth"),
    ("vertebrae", "vertebra"),
    ("vertices", "vertex"),
]

# ASCII spelling of letters that have no canonical decomposition.
LETTER_SPELLINGS = {
    "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "ß": "ss", "ẞ": "SS", "Ø": "O", "ø": "o",
    "Đ": "D", "đ": "d", "Ð": "D", "ð": "d", "Þ": "Th", "þ": "th", "Ł": "L", "ł": "l",
    "Ħ": "H", "ħ": "h", "ı": "i", "Ŋ": "NG", "ŋ": "ng", "Ŧ": "T", "ŧ": "t", "ĸ": "k",
}

# ASCII spelling of the small Greek and Cyrillic letters; capitals follow by rule.
GREEK_SPELLINGS = dict(zip(
    "α β γ δ ε ζ η θ ι κ λ μ ν ξ ο π ρ σ ς τ υ φ χ ψ ω".split(),
    "a b g d e z e th i k l m n x o p r s s t u ph kh ps o".split(),
    strict=True,
))
CYRILLIC_SPELLINGS = dict(zip(
    "а б в г д е ж з и й к л м н о п р с т у ф х ц ч ш щ ы э ю я".split(),
    "a b v g d e zh z i i k l m n o p r s t u f kh ts ch sh shch y e iu ia".split(),
    strict=True,
))

# ASCII spelling of signs and typographic punctuation.
SIGN_SPELLINGS = {
    " ": " ", "¡": "!", "¢": "C/", "£": "PS", "¥": "Y=", "¦": "|", "§": "SS", "¨": '"',
    "©": "(c)", "ª": "a", "«": "<<", "¬": "!", "®": "(r)", "¯": "-", "°": "deg", "±": "+-",
    "²": "2", "³": "3", "´": "'", "µ": "u", "¶": "P", "·": "*", "¸": ",", "¹": "1", "º": "o",
    "»": ">>", "¼": "1/4", "½": "1/2", "¾": "3/4", "¿": "?", "×": "x", "÷": "/",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "--", "―": "--", "‘": "'", "’": "'", "‚": ",",
    "‛": "'", "“": '"', "”": '"', "„": ",,", "‟": '"', "†": "+", "‡": "++", "•": "*", "…": "...",
    "‰": "%0", "′": "'", "″": '"', "‹": "<", "›": ">", "⁄": "/", "€": "EUR", "™": "(tm)",
    "−": "-", "≤": "<=", "≥": ">=", " ": " ", " ": " ", " ": " ", " ": " ",
    "　": " ", "。": ". ", "、": ", ",
}


def ascii_spellings() -> tuple[str, str, dict[str, str]]:
    """Split all spellings into two aligned strings (one letter each) and a longer-spelling table.

    Accented Latin letters come from Unicode decomposition, not from a table.
    """
    table: dict[str, str] = {}
    # Latin letters with marks, ligatures and full-width forms.
    for code in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00), *range(0xFB00, 0xFB07), *range(0xFF01, 0xFF5F)]:
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if ord(c) < 128)
        if base:
            table[chr(code)] = base
    for small, spelling in {**GREEK_SPELLINGS, **CYRILLIC_SPELLINGS}.items():
        table[small] = spelling
        table[small.upper()] = spelling.capitalize()
    # Greek and Cyrillic letters with marks are spelt as their base letter.
    for code in [*range(0x0370, 0x0460), *range(0x1F00, 0x2000)]:
        base = unicodedata.normalize("NFKD", chr(code))[0]
        if chr(code) not in table and base in table and unicodedata.category(chr(code))[0] == "L":
            table[chr(code)] = table[base]
    table.update(LETTER_SPELLINGS)
    table.update(SIGN_SPELLINGS)
    singles = {k: v for k, v in table.items() if len(v) == 1}
    longer = {k: v for k, v in table.items() if len(v) > 1}
    return "".join(singles), "".join(singles.values()), longer
