"""Queries over the supplied tables, with their SQL."""


def modules() -> list:
    """Modules with ``queries()`` and ``sql()``."""
    from kedge.plans import changes, links, reference

    return [changes, reference, links]
