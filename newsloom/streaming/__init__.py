"""newsloom.streaming"""
