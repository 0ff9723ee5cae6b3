"""Raw code-list text to code rows.

Code lists are typed as comma separated text over several lines.  Each text is
split on commas in full, every piece stripped of surrounding white space (lists
pasted from documents carry no-break and other spaces), and empty pieces dropped.  The piece's position in its text is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The characters stripped around each code, all that Python's str.strip() removes.
STRIP_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
               "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def parse_code_text(df: DataFrame, text_col: str = "text", code_col: str = "code",
                    pos_col: str = "code_pos") -> DataFrame:
    """Explode ``text_col`` into one row per code, other columns kept."""
    keep = [c for c in df.columns if c != text_col]
    pieces = df.select(*keep, F.posexplode(F.split(F.col(text_col), ",", -1)).alias(pos_col, "_piece"))
    return (pieces
            .withColumn(code_col, F.btrim(F.col("_piece"), F.lit(STRIP_CHARS)))
            .where(F.length(code_col) > 0)
            .drop("_piece"))
