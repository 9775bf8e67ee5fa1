"""The queries by name, each beside the SQL that gives the same rows."""

FOUND = {}


def query(sql=None):
    """Registers a function of (spark, sf_dir) under its name."""

    def add(f):
        FOUND[f.__name__] = (f, sql)
        return f

    return add
