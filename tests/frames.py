"""What several test modules read results with."""


def as_dicts(df, key="doc_id"):
    return {r[key]: r.asDict(recursive=True) for r in df.collect()}
