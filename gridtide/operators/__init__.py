"""Frame-to-frame operators: keep-last, cleaning, fact and daily-aggregate builders."""
