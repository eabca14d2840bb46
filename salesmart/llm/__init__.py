"""Operations of a large-scale training-data pipeline.

One module per operator; each takes and returns DataFrames and reads nothing
from the rest of the library but the shared-scratch helper of
``salesmart.session``.  ``queries`` registers one query per operator, with its
production parameters, over the whole table it is meant for.
"""
