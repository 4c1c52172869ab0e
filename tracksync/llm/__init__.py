"""Training-data operators: each module is one operator plus its catalog query.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its queries
only when it is there.
"""
