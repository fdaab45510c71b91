"""Word lists."""

from __future__ import annotations

# Spark ML's default English stop words.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself
it its itself they them their theirs themselves what which who whom this that these those am is are was were be
been being have has had having do does did doing a an the and but if or because as until while of at by for with
about against between into through during before after above below to from up down in out on off over under again
further then once here there when where why how all any both each few more most other some such no nor not only
own same so than too very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd
she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't weren't
haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could
here's how's let's ought that's there's what's when's where's who's why's would
""".split()

NEGATORS = ("not", "no", "never", "cannot", "without")
NEGATION_FACTOR = -0.5
# Fixed values end.

# Small general lexicon, put together by hand: word -> (polarity, subjectivity). For some common words the values are those usual in
# public English polarity lexicons. Replace it by passing a frame.
LEXICON = {
    "good": (0.7, 0.6), "great": (0.8, 0.75), "best": (1.0, 0.3), "better": (0.5, 0.5), "strong": (0.43, 0.73),
    "positive": (0.23, 0.55), "optimistic": (0.5, 0.7), "confident": (0.5, 0.83), "bullish": (0.6, 0.7),
    "gain": (0.4, 0.3), "gains": (0.4, 0.3), "rally": (0.4, 0.4), "surge": (0.45, 0.4), "surges": (0.45, 0.4),
    "beat": (0.4, 0.3), "beats": (0.4, 0.3), "profit": (0.35, 0.2), "growth": (0.35, 0.2), "record": (0.2, 0.2),
    "upgrade": (0.4, 0.3), "win": (0.8, 0.4), "wins": (0.3, 0.4), "stellar": (0.7, 0.8), "solid": (0.3, 0.4),
    "expansion": (0.25, 0.2), "breakout": (0.3, 0.4), "bad": (-0.7, 0.67), "worst": (-1.0, 1.0),
    "worthless": (-0.8, 0.9), "stupid": (-0.8, 1.0), "idiot": (-0.8, 0.8), "weak": (-0.38, 0.63),
    "negative": (-0.3, 0.4), "bearish": (-0.6, 0.7), "fall": (-0.35, 0.3), "falls": (-0.35, 0.3),
    "drop": (-0.35, 0.3), "dropped": (-0.35, 0.3), "dips": (-0.3, 0.3), "tumble": (-0.5, 0.4), "loss": (-0.4, 0.3),
    "losses": (-0.4, 0.3), "miss": (-0.35, 0.3), "misses": (-0.35, 0.3), "downgrade": (-0.45, 0.3),
    "scrutiny": (-0.3, 0.3), "delay": (-0.3, 0.2), "pressure": (-0.25, 0.3), "cut": (-0.25, 0.2),
    "headwind": (-0.3, 0.3), "selloff": (-0.45, 0.4), "slump": (-0.5, 0.4), "correction": (-0.25, 0.3),
    "risk": (-0.2, 0.3), "trap": (-0.4, 0.5), "volatile": (-0.2, 0.4), "uncertain": (-0.25, 0.5),
}
