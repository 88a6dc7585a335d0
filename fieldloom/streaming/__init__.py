"""Nothing streams here: profiling needs whole tables, so every operator is a batch one."""
