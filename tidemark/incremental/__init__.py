"""The daily job: each landing batch moves Silver, Gold, keys and facts on without reading old wide rows again."""
