"""Reading and writing: monthly raw files, the zone lookup file, and the layers of the lake."""
