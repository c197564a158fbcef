"""Operators for preparing training data: ten methods and their registered queries."""


def load():
    """Import the query module once and return it; it holds QUERIES and ORACLES."""
    from hearthline.llm import queries
    return queries
