"""A small labelled table for the personal-data field: lines with marks ``{kind|text}``.

Formats that the exact patterns do not know are marked as well as those they know.
Lines without marks show what is not personal data although it looks like it.
"""

LINES = """
Write to {email|anna.berg@mail.example.org} before Friday.
Contact: {email|j_smith77@corp.example.com}, or come by.
Reply at {email|team+news@lists.example.net}.
You can reach me under {email|maria [at] example [dot] org} any time.
Mail {email|peter(at)firma.de} wegen der Rechnung.
Schreib an {email|info [at] verein [dot] de} oder komm vorbei.
write {email|lena at example dot com} for the slides
my address is {email|john dot doe at mail dot com} thanks
email me: {email|sam AT shop DOT net} and ask
Contactez {email|claire (at) exemple (point) fr} pour plus.
Escriba a {email|luis[at]correo[dot]es} para saber.
Send it to {email|kim(at)web(dot)org}.
questions to {email|nora@localhost} please
{email|bob at foo dot org}
{email|karl [at] haus [dot] de}
{email|ina(at)post.net} or {email|uwe(at)post.net}
ask {email|eva at uni dot edu}, not me
see {email|max [at] club [dot] com} / {email|leo [at] club [dot] com}
then {email|anna at mail dot org} said yes
so the note says {email|tom at work dot net} and more
all of them know {email|rita at garden dot com} as well
old box {email|uma at north dot org} was closed, sadly
The team, {email|help dot desk at firm dot net}, answers.
Ping {ip|192.168.1.17} first, then reboot.
The server {ip|10.0.0.254} did not answer.
Blocked {ip|203.0.113.9}, twice today.
Connect to {ip|198.51.100.23:8080} with your key.
Host {ip|fe80::1ff:fe23:4567:890a} is up.
{ip|2001:db8::7:1} is new
and {ip|fe80::7:1} too
from {ip|2001:db8:85a3::8a2e:370:7334} to the gateway
Visit from {ip|2001:db8::1}, seen once.
login by {ip|172 [.] 16 [.] 0 [.] 9} was denied
Pay with {card|4111 1111 1111 1111} until noon.
Card {card|5500-0000-0000-0004} has expired.
He wrote down {card|4929348385146306} and left.
Die Karte {card|4556 7375 8689 9855} ist gesperrt.
the number {card|4556.7375.8689.9855} was on the slip
Carte {card|4716_1080_9997_1531} refusée.
{card|4556.1111.2222.3333}
number {card|6011/0009/9013/9424} on file
Call {phone|+1 (217) 555-0134} after six.
Tel. {phone|+49 30 901820} im Büro.
Phone {phone|+44 20 7946 0958}, ask for Kate.
Appelez le {phone|+33.1.42.68.53.00} demain.
Ring {phone|(217) 555-0134} or write.
please call {phone|(030) 555-7713} tonight
Our number is {phone|(974) 555-3436}.
dial {phone|217-555-0134} for help
Call {phone|555-0134} now.
Fax {phone|217.555.0134} only.
Tel: {phone|030/9018200} (Zentrale)
Telefon {phone|0049 30 901820} oder persönlich.
Llame al {phone|0034 912 345 678} hoy.
ruf an: {phone|0171-5551234} abends
mobile {phone|(0171) 5551234} anytime
{phone|(555) 123-4567}
{phone|(0711) 1234567} is mine
we had {phone|(0421) 7654321} before and then moved
so it was {phone|(0331) 2345678} all along
older was {phone|(089) 1234567} they said
{phone|555-123-4567} or {phone|555-987-6543}
tel {phone|030/1234567}
Tel. {phone|089/7654321}, Zimmer 12
Text {phone|1-800-555-0199} to stop.
the hotline {phone|1 (800) 555-0199} is free
Und die der, sehr alte Mühle am Fluss. Dann kam er.
Le château était fermé, mais la porte restait ouverte.
La niña comió pan y miel, después durmió.
The quick brown fox jumps over the lazy dog again and again.
They met at noon, at the old bridge, and talked.
Look at this dot on the map. It is at the top.
We sat at a table; the dot moved, at last.
Born on 2021-03-04 and filed on 12.11.2019, page 7.
On 04/07/1998 at 10:45 the sun rose; 23:59:59 was late.
Version 1.2.3 follows 1.2.2 and 0.9.
Release v2.10.4-beta and 3.0.0.rc1 are out.
The price was 1,299.00 or 12.50 each, 30 % off.
Chapter 4, section 12, pages 100-120 and 7-9.
Order 20210304 holds 17 items of 250 grams.
Invoice 2021-000123, customer 4711, part AB-1234-XZ.
Pi is 3.14159265358979 and e is 2.718281828.
In 1984, 1999 and 2001 there were 365 days.
The id 9807915762804490 appears nowhere else.
Numbers like 12345678901234567890 are long, 1234567890 less so.
Key = "90803a7f5cc1" and token = "ff00aa9912".
secret: 'a1b2c3d4e5f6' in the file config.yaml
See https://www.example.org/a/b?x=1&y=2 for more.
Go to http://example.com:8080/index.html or www.example.net today.
<div class="box"> <a href="x.html">text</a> </div>
if (x == 1) { return y[0]; } else { y += 2; }
import os, sys; print(os.path.join("a", "b"))
$$$ %%% &&& *** ||| ### ~~~ ^^^ === +++ --- ...
thing$$$ word%%% other&&& last*** end
col1 | col2 | col3 | 12 | 3.5 | -7
- first point
- second point: done
1. one 2. two 3. three (4) four [5] five
Room 12-34, seats 5-6-7, score 3:2 and 10-9.
ISBN 978-3-16-148410-0 and DOI 10.1000/182 are given.
Size 12x34x56 cm, weight 7.5 kg, 220-240 V.
Call me later. Phone home! Mail is here. The card is red.
Write it down; ring the bell; the number is wrong.
Tel and fax are old words, mobile is newer.
@home and @work are tags, #7 too; a+b=c, c-d=e.
50+50=100, x@y is odd, 3@2 too.
user_name and file.name.txt, foo.bar() or a.b.c
ALL CAPS HERE AND THERE, SOME Mixed CaSe TOO.
"Quoted," she said; 'fine,' he said. (Really?) Yes!
MIT License (c) 2019-2021. All rights reserved.
x1 y22 z333 w4444 v55555 u666666 t7777777
12 123 1234 12345 123456 1234567 12345678
10.5 11.25 100.125 1.5.2 0.0.1
Temperature -12.5 to +30 degrees, +5 at night, +100 points.
It is 555 steps to 7713 and 0134 more.
(a) 555 (b) 217 (c) 12-34
""".strip().splitlines()
