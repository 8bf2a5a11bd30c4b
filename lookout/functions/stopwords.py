"""Word lists the normalisers must share with the original search engine.

FIXED VALUES: these lists are data, not logic. They must stay exactly as
written (same words, natural order) for results to agree.
"""

# FIXED VALUES -- the English stop-word list of the public NLTK stop-word
# corpus (179 words), in the order that corpus publishes it.
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd "
    "your yours yourself yourselves he him his himself she she's her hers "
    "herself it it's its itself they them their theirs themselves what which "
    "who whom this that that'll these those am is are was were be been being "
    "have has had having do does did doing a an the and but if or because as "
    "until while of at by for with about against between into through during "
    "before after above below to from up down in out on off over under again "
    "further then once here there when where why how all any both each few "
    "more most other some such no nor not only own same so than too very s t "
    "can will just don don't should should've now d ll m o re ve y ain aren "
    "aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't "
    "haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't "
    "shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn "
    "wouldn't"
).split()

# FIXED VALUES -- the 34 Italian function words the field search adds to
# the English list, in the order they were given.
ITALIAN_STOP_WORDS = (
    "il lo la i gli le un una del della dello dei di a ai al allo alle degli "
    "d da dal dallo in nel nello su sul sullo con per tra fra e"
).split()

# Union used by the field cleaner (order irrelevant for a set test).
COMBINED_STOP_WORDS = list(dict.fromkeys(ENGLISH_STOP_WORDS + ITALIAN_STOP_WORDS))

assert len(ENGLISH_STOP_WORDS) == 179
assert len(ITALIAN_STOP_WORDS) == 34


def sql_list(words) -> str:
    """Words as a SQL list literal body: 'a', 'b', ... (quotes doubled)."""
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)
