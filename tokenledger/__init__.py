"""tokenledger: Spark-native cost analytics for LLM API spend.

Provider usage feeds are normalised and priced against effective-dated rate
cards, reconciled against provider-reported and invoiced cost, split across
applications with explicit unallocated residuals, reconciled with request
telemetry, turned into token / unit economics, gated optimisation proposals,
experiment spending-limit evaluations, data-quality controls and semantic
measures.  Every step is a DataFrame transformation; nothing is collected to
the driver except one-row control verdicts.
"""

__version__ = "0.1.0"
