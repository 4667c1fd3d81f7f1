"""DataFrame -> DataFrame operators. Lazy but for pair and neighbour counts, which are
checkpointed when called, and for quantiles, vocabularies and fitted models.

A *symbols frame* has one row per text with a ``symbols`` array; ``with_symbols``
makes one and the other operators take one.
"""
