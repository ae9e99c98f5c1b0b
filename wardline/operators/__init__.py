from wardline.operators.joins import anti_join, prefilter
from wardline.operators.ranking import dense_rank_desc
from wardline.operators.repeat import repeat_rows
from wardline.operators.totals import with_total

__all__ = ["anti_join", "dense_rank_desc", "prefilter", "repeat_rows", "with_total"]
