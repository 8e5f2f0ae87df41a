"""newsloom.sources"""
