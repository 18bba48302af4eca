"""Parameters of the registered queries."""

# Sample list of competitor names.
COMPETITORS = [
    "Acorns",
    "Citigroup",
    "Citi",
    "Fidelity Investments",
    "Fidelity",
    "JP Morgan Chase and company",
    "JP Morgan",
    "JP Morgan Chase",
    "JPMorgan Chase",
    "ChaseM1 Finance",
    "Stash Financial Incorporated",
    "Stash",
    "Tastytrade Incorporated",
    "Tastytrade",
    "ZacksTrade",
    "Zacks Trade",
]

# Words that the tables contain, so that the rules have something to find.
BANNED = [*COMPETITORS, "worthless", "pathetic", "Clown", "moron", "the of"]
CUES = ["that", "nicht", "dans", "por"]
