"""Where data comes from: memory, text files, binary files, image archives."""
