"""Word lists, patterns, aliases and search terms the results depend on."""

# Patterns. Digits are Unicode decimal digits.
TOKEN = r"[A-Za-z]+(?:'[A-Za-z]+)?|\p{Nd}+(?:\.\p{Nd}+)?%?|[$%]|[+-]"
NUMBER = r"\p{Nd}+(?:\.\p{Nd}+)?"
PERCENT = r"\p{Nd}+(?:\.\p{Nd}+)?%"
CONTRACTION = r"n't\b"

# Word lists.
FINANCIAL = (
    "profit", "loss", "growth", "decline", "revenue", "earnings", "exceeded", "rose", "fell",
    "increased", "decreased", "gain", "drop", "surged", "plunged", "dividend", "forecast", "margin",
    "debt", "sales", "cost", "income", "expense", "deficit", "surplus",
)
POSITIVE = (
    "profit", "growth", "rose", "increased", "gain", "surged", "exceeded", "surplus", "dividend",
)
NEGATIVE = (
    "loss", "decline", "fell", "decreased", "drop", "plunged", "debt", "deficit", "expense", "cost",
)
# "n't" is part of the list but no token can equal it, so it never counts.
NEGATION = ("no", "not", "nor", "never", "n't", "neither", "nobody", "nothing")

# Words that mark the following token as negated, and that survive stop-word removal.
NEGATORS = ("no", "not", "nor", "never")

# Names that may stand for a ticker in a headline.
TICKER_ALIASES = {
    "AAPL": ("apple",),
    "MSFT": ("microsoft",),
    "AMZN": ("amazon",),
    "GOOGL": ("google", "alphabet"),
    "META": ("meta", "facebook"),
    "NVDA": ("nvidia",),
    "JPM": ("jpmorgan", "jp morgan", "chase"),
    "JNJ": ("johnson & johnson", "johnson and johnson"),
    "TSLA": ("tesla",),
    "AMD": ("amd", "advanced micro devices"),
    "QCOM": ("qualcomm",),
    "SHOP": ("shopify",),
    "ROKU": ("roku",),
    "ETSY": ("etsy",),
    "UPST": ("upstart",),
    "FSLY": ("fastly",),
    "RBLX": ("roblox",),
    "SPY": ("s&p 500", "s&p500"),
}

# Default search terms per ticker; a ticker without an entry searches for itself.
SEARCH_TERMS = {
    "AAPL": ("AAPL", "Apple"),
    "MSFT": ("MSFT", "Microsoft"),
    "AMZN": ("AMZN", "Amazon"),
    "GOOGL": ("GOOGL", "Google", "Alphabet"),
    "META": ("META", "Meta Platforms", "Facebook"),
    "NVDA": ("NVDA", "Nvidia"),
    "JPM": ("JPM", "JPMorgan", "JP Morgan"),
    "JNJ": ("JNJ", "Johnson & Johnson"),
    "TSLA": ("TSLA", "Tesla"),
    "AMD": ("AMD", "Advanced Micro Devices"),
    "QCOM": ("QCOM", "Qualcomm"),
    "SHOP": ("SHOP", "Shopify"),
    "ROKU": ("ROKU", "Roku"),
    "ETSY": ("ETSY", "Etsy"),
    "UPST": ("UPST", "Upstart"),
    "FSLY": ("FSLY", "Fastly"),
    "RBLX": ("RBLX", "Roblox"),
}

LABEL_NAMES = ("negative", "neutral", "positive")
SUBSETS = ("sentences_allagree", "sentences_75agree", "sentences_66agree", "sentences_50agree")
