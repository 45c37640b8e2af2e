"""Fixed values that results are held against."""

# fixed values: year, then annual totals of the stations 1030, 1038 and 1029
ANNUAL = [
    (1980, 1340.9, 1349.1, 969.9), (1981, 1370.7, 1142.3, 1158.8), (1982, 1169.2, 1132.5, 1159.7),
    (1983, 1449.6, 1714.4, 1308.5), (1984, 1314.0, 1307.2, 1329.3), (1985, 1785.1, 2131.6, 1533.1),
    (1986, 1493.8, 1757.3, 1364.6), (1987, 1395.2, 1304.0, 1449.2), (1988, 1441.0, 1717.0, 1496.8),
    (1989, 1132.0, 1022.7, 996.3), (1990, 1614.7, 1674.0, 1173.9), (1991, 1067.9, 1210.9, 870.0),
    (1992, 1093.1, 1264.4, 827.2), (1993, 1306.0, 1370.9, 1198.4), (1994, 1579.2, 1545.1, 1227.4),
    (1995, 1673.8, 1918.3, 1296.2), (1996, 1599.7, 1540.5, 1125.9), (1997, 1528.3, 1720.7, 1134.7),
    (1998, 1770.8, 2003.6, 1155.3), (1999, 1735.5, 3025.2, 1275.1), (2000, 1407.0, 2014.9, 1196.0),
    (2001, 1620.9, 1415.9, 991.2), (2002, 1871.0, 1804.2, 1535.3), (2003, 1740.0, 2100.6, 1440.4),
    (2004, 1609.6, 1540.0, 1105.0), (2005, 1235.9, 1303.4, 940.3), (2006, 1391.2, 1472.1, 1064.4),
    (2007, 1345.9, 1474.2, 1322.0), (2008, 1219.9, 1417.3, 1136.1), (2009, 1205.4, 1144.0, 972.1),
    (2010, 1478.7, 1373.8, 1130.2), (2011, 1654.8, 1774.0, 1653.1), (2012, 1464.7, 1699.1, 1118.4),
    (2013, 1899.3, 1731.7, 1288.0), (2014, 1578.6, 1358.6, 1000.9), (2015, 1649.4, 966.6, 959.7),
    (2016, 1482.8, 1135.6, 1098.4), (2017, 1279.3, 1179.3, 1053.9),
]

# fixed values: statistic, last year before the break, break year, means before and after, simulated p value
SNHT = {
    "1030": (6.614206094611036, 1993, 1994, 1355.2285714285715, 1542.5708333333332, 0.1131),
    "1038": (4.340316189066301, 2013, 2014, 1591.6735294117648, 1160.0249999999999, 0.361),
    "1029": (4.593743878751333, 1988, 1989, 1307.7666666666664, 1147.786206896552, 0.318),
}

# fixed values: year, normalised candidate 1030, reference, ratio
RELATIVE = [(1980, 0.910, 0.848, 1.074), (1981, 0.930, 0.848, 1.097), (1982, 0.793, 0.845, 0.939), (2013, 1.289, 1.105, 1.167), (2014, 1.071, 0.863, 1.242), (2017, 0.868, 0.820, 1.058)]
