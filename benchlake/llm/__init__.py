"""Operators of a training-data pipeline, with their registered queries and oracle SQL."""


def queries():
    """The opN_<name> queries and the pipeline; imported late, so that a worker which needs one
    operator loads that operator alone."""
    from benchlake.llm import registry

    return registry.queries()


def oracle_sql():
    from benchlake.llm import registry

    return registry.oracle_sql()
