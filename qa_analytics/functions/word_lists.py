"""Word lists.

Everything in this module is a fixed value that results depend on; all lists
are defaults of parameters.
"""

# English stop words made of letters only (entries with an
# apostrophe can never match cleaned text, which has no apostrophes).
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him
his himself she her hers herself it its itself they them their theirs
themselves what which who whom this that these those am is are was were be been
being have has had having do does did doing a an the and but if or because as
until while of at by for with about against between into through during before
after above below to from up down in out on off over under again further then
once here there when where why how all any both each few more most other some
such no nor not only own same so than too very s t can will just don should now
d ll m o re ve y ain aren couldn didn doesn hadn hasn haven isn ma mightn mustn
needn shan shouldn wasn weren won wouldn
""".split()

# Forms that the word tokeniser splits in two.
SPLIT_FORMS = {
    "cannot": "can not",
    "gimme": "gim me",
    "gonna": "gon na",
    "gotta": "got ta",
    "lemme": "lem me",
    "wanna": "wan na",
}

# Technical terms, matched as whole words.
TECHNICAL_TERMS = [
    "function", "class", "method", "variable", "algorithm", "library",
    "framework", "api", "database", "server", "client", "code", "syntax",
    "error", "exception", "debug", "compile", "runtime", "async", "await",
]

# Advanced topics, matched as substrings.
ADVANCED_TERMS = [
    "performance", "optimization", "architecture", "design pattern",
    "security", "scalability", "microservices", "deployment", "testing",
    "refactoring", "best practices", "clean code",
]

# Signs of a question, matched as substrings.
QUESTION_SIGNS = [
    "how", "what", "why", "when", "where", "which", "can", "should",
    "is", "are", "does", "do", "will", "would", "?",
]

# Signs of code, matched as substrings.
CODE_SIGNS = ["code", "function", "method", "class"]

# Sentiment words with a polarity in [-1, 1]. A small approximation; pass a
# lexicon DataFrame for real use.
SENTIMENT_WORDS = {
    "amazing": 0.6, "awesome": 1.0, "awful": -1.0, "bad": -0.7, "beautiful": 0.85,
    "best": 1.0, "better": 0.5, "boring": -1.0, "broken": -0.4, "clean": 0.37,
    "clear": 0.1, "confusing": -0.3, "correct": 0.2, "cool": 0.35, "difficult": -0.5,
    "disgusting": -1.0, "easy": 0.43, "excellent": 1.0, "fail": -0.5, "fast": 0.2,
    "fine": 0.42, "good": 0.7, "great": 0.8, "hard": -0.29, "helpful": 0.5,
    "horrible": -1.0, "interesting": 0.5, "nice": 0.6, "perfect": 1.0, "poor": -0.4,
    "right": 0.29, "sad": -0.5, "simple": 0.1, "slow": -0.3, "stupid": -0.8,
    "terrible": -1.0, "ugly": -0.7, "useful": 0.3, "useless": -0.5, "weird": -0.5,
    "wonderful": 1.0, "worst": -1.0, "worthless": -0.8, "wrong": -0.5,
}

# Words that scale the sentiment word right after them.
INTENSITY_WORDS = {
    "very": 1.3, "really": 1.2, "extremely": 1.5, "so": 1.2, "quite": 1.1,
    "pretty": 1.1, "slightly": 0.5, "somewhat": 0.6, "hardly": 0.5,
}

# Words that turn the sentiment word after them into its opposite, halved.
NEGATIONS = ["no", "not", "n't", "never", "none", "neither", "cannot", "can't", "don't", "isn't", "doesn't", "won't"]
