"""newsloom.functions"""
