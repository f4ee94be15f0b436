"""Helpers of the corpus operators' tests."""


def words(n, start=0):
    return " ".join(f"w{k}" for k in range(start, start + n))


def duck(sql, **frames):
    """Rows of DuckDB SQL over pandas frames, columns sorted by name."""
    import duckdb
    con = duckdb.connect()
    for name, frame in frames.items():
        con.register(name, frame)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(r[k] for k in order) for r in cur.fetchall()), key=repr)


def rows_of(df):
    names = sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)
