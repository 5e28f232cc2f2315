"""Help for the tests of this folder."""


def no_python(df) -> bool:
    plan = df._jdf.queryExecution().toString()
    return not any(name in plan for name in ("Python", "Arrow", "Pandas"))
