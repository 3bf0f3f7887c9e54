from tokloom.functions.hashing import phash, uniform, uniform_int  # noqa: F401
