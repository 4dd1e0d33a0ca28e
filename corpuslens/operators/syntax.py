"""Python syntax gate, the one check that has to run in Python."""

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower-case language names whose files are expected to parse.
PYTHON = ("python",)


def parses_as_python(text: Column) -> Column:
    """True where the text parses under the interpreter of the workers, false for null.

    Syntax errors, NUL bytes and nesting too deep to parse all count as not parsing.
    """

    # Nested so that it is shipped by value and workers need not have this package.
    def check(texts: pd.Series) -> pd.Series:
        import ast
        import warnings

        def parses(source):
            if source is None:
                return False
            try:
                ast.parse(source)
            except (SyntaxError, ValueError, RecursionError, MemoryError):
                return False
            return True

        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            return texts.map(parses).astype(bool)

    return F.pandas_udf(check, "boolean")(text)
