"""Jobs: the card mart (``mart``), its audit re-statement (``audit``), the
calendar jobs (``calendar_jobs``) and the table sinks (``sinks``).  Each job is
a function from DataFrames to a DataFrame; nothing runs until an action."""
